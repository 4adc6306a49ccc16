"""Linear scorecard: score, per-feature contributions and explanations.

A fitted logistic model reduces to an intercept plus one coefficient per
(categorical feature, level) and a slope per numeric feature.  The
coefficient table is tiny and fixed, so scoring is one row-local projection
(generated ``CASE`` expressions), and explanations are row-local too: an
array of (feature, contribution) structs, sorted by |contribution| and
sliced -- no shuffle, no Python.

The default scorecard below is the fixed model the application fixtures are
scored with (it stands in for the trained champion in the oracle checks).
A scorecard fitted by ``decisionops.ml`` can be passed the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scorecard:
    intercept: float
    # feature -> {level: coefficient}; key None is the coefficient for a
    # missing value; unseen levels contribute 0.
    categorical: dict = field(default_factory=dict)
    # feature -> (slope, centre); contribution slope * (x - centre), null -> 0
    numeric: dict = field(default_factory=dict)
    name: str = "scorecard"

    @property
    def features(self) -> list[str]:
        return list(self.categorical) + list(self.numeric)

    def rows(self):
        """(feature, level, coefficient) rows of the coefficient table."""
        out = [("(intercept)", None, self.intercept)]
        for f, levels in self.categorical.items():
            out += [(f, lvl, c) for lvl, c in levels.items()]
        out += [(f, "slope", s) for f, (s, _) in self.numeric.items()]
        return out


# The default scorecard of the application fixtures.
DEFAULT_SCORECARD = Scorecard(
    intercept=-1.2,
    categorical={
        "credit_history": {"1": 2.3, "0": -1.4, None: 0.5},
        "married": {"Yes": 0.25, "No": -0.15, None: 0.0},
        "dependents": {"0": 0.05, "1": -0.05, "2": 0.1, "3+": -0.12, None: 0.0},
        "education": {"Graduate": 0.2, "Not Graduate": -0.2, None: 0.0},
        "self_employed": {"Yes": -0.1, "No": 0.05, None: 0.0},
        "property_area": {"Semiurban": 0.35, "Urban": 0.05, "Rural": -0.25, None: 0.0},
    },
    numeric={
        "log_total_income": (0.3, 8.0),
        "log_loan_amount": (-0.4, 5.0),
        "loan_amount_term": (-0.002, 360.0),
    },
    name="scorecard_v1",
)

# Categorical inputs stored as numbers are compared as their integer text.
_AS_TEXT = {"credit_history"}


def _level_col(f: str) -> Column:
    c = F.col(f)
    return c.cast("int").cast("string") if f in _AS_TEXT else c


def _level_sql(f: str) -> str:
    return f"CAST(CAST({f} AS INTEGER) AS VARCHAR)" if f in _AS_TEXT else f


def contribution(sc: Scorecard, f: str) -> Column:
    if f in sc.categorical:
        levels = sc.categorical[f]
        lv = _level_col(f)
        out = F.when(lv.isNull(), F.lit(float(levels.get(None, 0.0))))
        for lvl, coef in levels.items():
            if lvl is not None:
                out = out.when(lv == lvl, F.lit(float(coef)))
        return out.otherwise(F.lit(0.0))
    slope, centre = sc.numeric[f]
    return F.coalesce(F.lit(float(slope)) * (F.col(f) - F.lit(float(centre))), F.lit(0.0))


def contribution_sql(sc: Scorecard, f: str) -> str:
    if f in sc.categorical:
        levels = sc.categorical[f]
        lv = _level_sql(f)
        parts = [f"WHEN {lv} IS NULL THEN {float(levels.get(None, 0.0))!r}"]
        parts += [f"WHEN {lv} = '{lvl}' THEN {float(c)!r}" for lvl, c in levels.items() if lvl is not None]
        return "(CASE " + " ".join(parts) + " ELSE 0.0 END)::DOUBLE"
    slope, centre = sc.numeric[f]
    return f"coalesce({float(slope)!r} * ({f} - {float(centre)!r}), 0.0)::DOUBLE"


def logit(sc: Scorecard) -> Column:
    z = F.lit(float(sc.intercept))
    for f in sc.features:
        z = z + contribution(sc, f)
    return z


def logit_sql(sc: Scorecard) -> str:
    return "(" + " + ".join([f"{float(sc.intercept)!r}"] + [contribution_sql(sc, f) for f in sc.features]) + ")"


def probability(sc: Scorecard) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit(sc)))


def probability_sql(sc: Scorecard) -> str:
    return f"(1.0 / (1.0 + exp(-{logit_sql(sc)})))"


def score(df: DataFrame, sc: Scorecard = DEFAULT_SCORECARD, out: str = "approval_probability") -> DataFrame:
    return df.withColumn(out, probability(sc))


def factors(df: DataFrame, id_col: str, sc: Scorecard = DEFAULT_SCORECARD, top_n: int = 6) -> DataFrame:
    """Top-n features per row by |contribution| (ties by feature name), as
    rows (id, rank, feature, contribution, direction).  Row-local."""
    # ascending by -|contribution|, then feature
    arr = F.array(*[F.struct((-F.abs(contribution(sc, f))).alias("mag"), F.lit(f).alias("feature"),
                             contribution(sc, f).alias("contribution")) for f in sc.features])
    top = F.slice(F.sort_array(arr), 1, top_n)
    return (df.select(id_col, F.posexplode(top).alias("pos", "f"))
              .select(id_col, (F.col("pos") + 1).cast("long").alias("rank"),
                      F.col("f.feature").alias("feature"),
                      F.round(F.col("f.contribution"), 6).alias("contribution"),
                      F.when(F.col("f.contribution") >= 0, "supports").otherwise("reduces")
                      .alias("direction")))
