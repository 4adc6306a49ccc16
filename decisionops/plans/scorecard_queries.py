"""Scorecard scoring, explanations, sensitivity, ensemble, importance,
fold leaderboard and blend search (Spark + DuckDB)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clip_sql, fround, fround_sql
from ..operators import blend as bl
from ..operators import evaluate as ev
from ..operators import split as sp
from ..operators.features import add_v1_features
from ..operators.scorecard import (DEFAULT_SCORECARD, Scorecard, contribution, contribution_sql, factors,
                                   probability, probability_sql)
from .fixtures import SQL_APPLICATIONS_V1, V1_CATEGORICAL, V1_NUMERIC_RAW, V1_PREDICTORS, applications_v1
from .model_queries import FOLD_SEED, FOLDS, SPLIT_SEED, TEST_SIZE

# The challenger and the third ensemble member (ours).
CHALLENGER = Scorecard(
    intercept=-0.9,
    categorical={"credit_history": {"1": 2.0, "0": -1.8, None: 0.2},
                 "property_area": {"Semiurban": 0.25, "Urban": 0.0, "Rural": -0.15, None: 0.0},
                 "married": {"Yes": 0.1, "No": -0.1, None: 0.0}},
    numeric={"log_total_income": (0.2, 8.0), "log_loan_amount": (-0.3, 5.0)},
    name="challenger_v1")
CREDIT_ONLY = Scorecard(intercept=-0.3, categorical={"credit_history": {"1": 1.8, "0": -2.2, None: 0.0}},
                        numeric={}, name="credit_only")
MEMBERS = [(DEFAULT_SCORECARD, 0.5), (CHALLENGER, 0.3), (CREDIT_ONLY, 0.2)]
CANDIDATES = [DEFAULT_SCORECARD, CHALLENGER, CREDIT_ONLY]
CHAMPION_FAMILY = ["scorecard_v1", "credit_only"]
ENSEMBLE_THRESHOLD = 0.5
TOP_FACTORS = 6


def _base(spark, sf_dir) -> DataFrame:
    return add_v1_features(applications_v1(spark, sf_dir))


_FEAT_SQL = f""",
f1 AS (SELECT *, coalesce(applicant_income, 0.0) + coalesce(coapplicant_income, 0.0) AS total_income
       FROM applications_v1),
feat AS (SELECT *, ln(1.0 + {clip_sql('total_income', 0.0)}) AS log_total_income,
                ln(1.0 + {clip_sql('loan_amount', 0.0)}) AS log_loan_amount FROM f1)"""


# ------------------------------------------------------------------ Spark

def scorecard_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _base(spark, sf_dir)
    p, pc = probability(DEFAULT_SCORECARD), probability(CHALLENGER)
    approved = p >= 0.5
    return b.select(
        "application_id", F.round(p, 6).alias("approval_probability"),
        F.round(F.lit(1.0) - p, 6).alias("rejection_probability"),
        approved.alias("approved"),
        F.round(F.when(approved, p).otherwise(F.lit(1.0) - p), 6).alias("confidence"),
        F.round(pc, 6).alias("challenger_probability"),
        (approved == (pc >= 0.5)).alias("models_agree"))


def scorecard_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors(_base(spark, sf_dir), "application_id", DEFAULT_SCORECARD, TOP_FACTORS)


def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _base(spark, sf_dir)
    ps = [probability(sc) for sc, _ in MEMBERS]
    ens = None
    for (sc, w), p in zip(MEMBERS, ps):
        ens = F.lit(w) * p if ens is None else ens + F.lit(w) * p
    x = b.select("application_id", *[p.alias(f"p_{sc.name}") for (sc, _), p in zip(MEMBERS, ps)],
                 ens.alias("p"))
    appr = F.col("p") >= ENSEMBLE_THRESHOLD
    return x.select("application_id", *[F.round(f"p_{sc.name}", 6).alias(f"p_{sc.name}") for sc, _ in MEMBERS],
                    F.round("p", 6).alias("ensemble_probability"), appr.alias("approved"),
                    F.round(F.when(appr, F.col("p")).otherwise(1.0 - F.col("p")), 6).alias("confidence"))


def _dev_rows(rows: DataFrame) -> DataFrame:
    """Rows of the development split (the holdout is never looked at)."""
    y = rows.withColumn("y", (F.trim(F.col("loan_status")) == "Y").cast("int"))
    s = sp.stratified_split(y.select("application_id", "y"), "application_id", "y", TEST_SIZE, SPLIT_SEED)
    return y.join(s.where(F.col("split") == "dev").select("application_id"), "application_id")


def _baseline_row(spark, sf_dir) -> DataFrame:
    a = _dev_rows(applications_v1(spark, sf_dir)).withColumn(
        "credit_history", F.col("credit_history").cast("int").cast("string"))
    bl_long = ev.feature_baselines(a, V1_CATEGORICAL, V1_NUMERIC_RAW)
    return bl_long.agg(*[F.max(F.when(F.col("feature") == f, F.col("category" if f in V1_CATEGORICAL
                                                                   else "number"))).alias(f"b_{f}")
                         for f in V1_PREDICTORS])


def local_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raw predictor replaced by its baseline (mode / median), the row
    re-scored; top-6 |delta| per row.  Row-local: the ten variant scores are
    columns of one projection, sorted inside an array and sliced -- no
    explode before the ranking and no shuffle by id."""
    sc = DEFAULT_SCORECARD
    x = add_v1_features(applications_v1(spark, sf_dir))
    x = x.crossJoin(F.broadcast(_baseline_row(spark, sf_dir)))

    def with_baseline(f):
        """The scorecard feature that predictor f moves, and its value at f's baseline."""
        b = F.col(f"b_{f}")
        if f in ("applicant_income", "coapplicant_income"):
            a, c = (b if g == f else F.col(g) for g in ("applicant_income", "coapplicant_income"))
            total = F.coalesce(a, F.lit(0.0)) + F.coalesce(c, F.lit(0.0))
            return "log_total_income", F.log(F.lit(1.0) + F.when(total < 0, F.lit(0.0)).otherwise(total))
        if f == "loan_amount":
            return "log_loan_amount", F.log(F.lit(1.0) + F.when(b < 0, F.lit(0.0)).otherwise(b))
        return f, b.cast("double") if f == "credit_history" else b

    # every term once, the logit once; a variant exchanges the one term that it moves
    terms = {f: contribution(sc, f) for f in sc.features}
    moved = {f: with_baseline(f) for f in V1_PREDICTORS}
    x = x.select("application_id", *[c.alias(f"t_{f}") for f, c in terms.items()],
                 *[term_of(sc, g, v).alias(f"n_{f}") for f, (g, v) in moved.items()])
    z = F.lit(float(sc.intercept))
    for f in sc.features:
        z = z + F.col(f"t_{f}")
    x = x.withColumn("z", z)

    def p(z):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    x = x.select("application_id", *[(p(F.col("z")) - p(F.col("z") - F.col(f"t_{g}") + F.col(f"n_{f}"))).alias(f"d_{f}")
                                     for f, (g, _) in moved.items()])
    items = [F.struct((-F.abs(fround(F.col(f"d_{f}"), 9))).alias("mag"), F.lit(f).alias("feature"),
                      F.col(f"d_{f}").alias("delta")) for f in V1_PREDICTORS]
    top = F.slice(F.sort_array(F.array(*items)), 1, TOP_FACTORS)       # largest first, then by name
    return (x.select("application_id", F.posexplode(top).alias("pos", "v"))
             .select("application_id", (F.col("pos") + 1).cast("long").alias("rank"),
                     F.col("v.feature").alias("feature"), (F.round("v.delta", 6) + F.lit(0.0)).alias("delta")))


def term_of(sc: Scorecard, f: str, c):
    """The scorecard's term of feature f for a value given as a column expression."""
    if f in sc.categorical:
        levels = sc.categorical[f]
        lv = c.cast("int").cast("string") if f == "credit_history" else c
        e = F.when(lv.isNull(), F.lit(float(levels.get(None, 0.0))))
        for lvl, coef in levels.items():
            if lvl is not None:
                e = e.when(lv == lvl, F.lit(float(coef)))
        return e.otherwise(F.lit(0.0))
    slope, centre = sc.numeric[f]
    return F.coalesce(F.lit(float(slope)) * (c - F.lit(float(centre))), F.lit(0.0))


def _probability_of(sc: Scorecard, cols: dict):
    """The scorecard probability over given column expressions."""
    z = F.lit(float(sc.intercept))
    for f in sc.features:
        z = z + term_of(sc, f, cols[f])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _encoded_long(spark, sf_dir) -> DataFrame:
    sc = DEFAULT_SCORECARD
    b = _base(spark, sf_dir)
    items = []
    for f in sc.features:
        if f in sc.categorical:
            lv = F.col(f).cast("int").cast("string") if f == "credit_history" else F.col(f)
            level = F.coalesce(lv, F.lit("Missing"))
        else:
            level = F.lit("slope")
        items.append(F.struct(F.lit(f).alias("feature"), level.alias("level"),
                              F.abs(contribution(sc, f)).alias("imp")))
    return b.select(F.explode(F.array(*items)).alias("e")).select("e.*")


def importance_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean |contribution| per encoded column (feature, level), with share."""
    e = _encoded_long(spark, sf_dir)
    n = _base(spark, sf_dir).agg(F.count(F.lit(1)).alias("_n"))
    g = e.groupBy("feature", "level").agg(F.sum("imp").alias("s")).crossJoin(F.broadcast(n))
    g = g.withColumn("importance", F.col("s") / F.col("_n"))
    tot = g.agg(F.sum("importance").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(
        "feature", "level", F.round("importance", 6).alias("importance"),
        F.round(F.when(F.col("_t") > 0, F.col("importance") / F.col("_t")).otherwise(F.lit(1.0)), 6).alias("share"))


def importance_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded importances summed to the base feature, with share of total."""
    e = _encoded_long(spark, sf_dir)
    g = e.groupBy("feature").agg(F.avg("imp").alias("importance"))
    tot = g.agg(F.sum("importance").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(
        "feature", F.round("importance", 6).alias("importance"),
        F.round(F.when(F.col("_t") > 0, F.col("importance") / F.col("_t")).otherwise(F.lit(1.0)), 6).alias("share"))


def _candidate_long(spark, sf_dir) -> DataFrame:
    b = _base(spark, sf_dir).withColumn("y", (F.trim(F.col("loan_status")) == "Y").cast("int"))
    folds = sp.stratified_folds(b.select("application_id", "y"), "application_id", "y", FOLDS, FOLD_SEED)
    b = b.join(folds.select("application_id", "fold"), "application_id")
    arr = F.array(*[F.struct(F.lit(sc.name).alias("model"), probability(sc).alias("p")) for sc in CANDIDATES])
    return b.select("application_id", "y", "fold", F.explode(arr).alias("m")).select(
        "application_id", "y", "fold", "m.model", "m.p")


def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _candidate_long(spark, sf_dir)
    m = ev.classification_metrics(long, "y", "p", 0.5, ["model", "fold"])
    a = ev.auc(long, "y", "p", ["model", "fold"])
    return m.join(a, ["model", "fold"]).select("model", "fold", "accuracy", "balanced_accuracy", "auc", "f1")


def _leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.mean_std_over_folds(fold_metrics(spark, sf_dir), ["model"],
                                  ["accuracy", "balanced_accuracy", "auc", "f1"])


def _rounded(leaders: DataFrame) -> list:
    return ["model", *[F.round(c, 6).alias(c) for c in leaders.columns if c != "model"]]


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _leaders(spark, sf_dir)
    return s.orderBy(F.col("auc_mean").desc(), F.col("balanced_accuracy_mean").desc(), "model").select(*_rounded(s))


def pick_champion(leaders: DataFrame) -> DataFrame:
    """The first row in leaderboard order (unrounded metrics; on a tie the
    smaller name)."""
    first = F.min_by(F.struct(*leaders.columns), F.struct(-F.col("auc_mean"), -F.col("balanced_accuracy_mean"), "model"))
    return leaders.agg(first.alias("c")).select("c.*").where(F.col("model").isNotNull())


def champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = pick_champion(_leaders(spark, sf_dir).where(F.col("model").isin(*CHAMPION_FAMILY)))
    return c.select(*_rounded(c))


def blend_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights + threshold chosen on dev rows only (the test split is held out)."""
    dev = _dev_rows(_base(spark, sf_dir))
    members = [f"p_{sc.name}" for sc in CANDIDATES]
    dev = dev.select("y", *[probability(sc).alias(f"p_{sc.name}") for sc in CANDIDATES])
    r = bl.blend_search(dev, members, "y")
    return r.select(*[c for c in r.columns if c.startswith("w")], "threshold",
                    *[fround(c, 9).alias(c) for c in ("accuracy", "balanced_accuracy", "auc")])


# ------------------------------------------------------------------ DuckDB

def sql_scorecard_scores() -> str:
    p, pc = probability_sql(DEFAULT_SCORECARD), probability_sql(CHALLENGER)
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + f""",
s AS (SELECT application_id, {p} AS p, {pc} AS pc FROM feat)
SELECT application_id, round(p, 6) AS approval_probability, round(1.0 - p, 6) AS rejection_probability,
  p >= 0.5 AS approved, round(CASE WHEN p >= 0.5 THEN p ELSE 1.0 - p END, 6) AS confidence,
  round(pc, 6) AS challenger_probability, (p >= 0.5) = (pc >= 0.5) AS models_agree
FROM s"""


def sql_scorecard_factors() -> str:
    sc = DEFAULT_SCORECARD
    parts = [f"SELECT application_id, '{f}' AS feature, {contribution_sql(sc, f)} AS contribution FROM feat"
             for f in sc.features]
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + f""",
c AS ({" UNION ALL ".join(parts)}),
r AS (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY abs(contribution) DESC, feature ASC) AS rk
      FROM c)
SELECT application_id, CAST(rk AS BIGINT) AS rank, feature, round(contribution, 6) AS contribution,
  CASE WHEN contribution >= 0 THEN 'supports' ELSE 'reduces' END AS direction
FROM r WHERE rk <= {TOP_FACTORS}"""


def sql_ensemble_scores() -> str:
    cols = ", ".join(f"{probability_sql(sc)} AS p_{sc.name}" for sc, _ in MEMBERS)
    ens = " + ".join(f"{w!r} * p_{sc.name}" for sc, w in MEMBERS)
    rnd = ", ".join(f"round(p_{sc.name}, 6) AS p_{sc.name}" for sc, _ in MEMBERS)
    t = ENSEMBLE_THRESHOLD
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + f""",
m AS (SELECT application_id, {cols} FROM feat),
e AS (SELECT *, {ens} AS p FROM m)
SELECT application_id, {rnd}, round(p, 6) AS ensemble_probability, p >= {t} AS approved,
  round(CASE WHEN p >= {t} THEN p ELSE 1.0 - p END, 6) AS confidence
FROM e"""


def _baselines_sql() -> str:
    cats = []
    for c in V1_CATEGORICAL:
        v = f"CAST(CAST({c} AS INTEGER) AS VARCHAR)" if c == "credit_history" else f"CAST({c} AS VARCHAR)"
        cats.append(f"""coalesce((SELECT v FROM (SELECT {v} AS v, count(*) AS c FROM dev_rows
            WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY c DESC, v ASC LIMIT 1), 'Unknown') AS b_{c}""")
    nums = [f"(SELECT coalesce(quantile_cont({c}, 0.5), 0.0) FROM dev_rows) AS b_{c}" for c in V1_NUMERIC_RAW]
    return f""",
dev_rows AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY trim(loan_status) = 'Y'
              ORDER BY {sp.order_key_sql('application_id', SPLIT_SEED)}, application_id) - 1 AS rn_,
            count(*) OVER (PARTITION BY trim(loan_status) = 'Y') AS n_ FROM applications_v1)
  WHERE NOT (rn_ < floor(n_ * {TEST_SIZE} + 0.5))),
base AS (SELECT {', '.join(cats + nums)})"""


def sql_local_sensitivity() -> str:
    sc = DEFAULT_SCORECARD
    parts = []
    for f in V1_PREDICTORS:
        cols = []
        for g in V1_PREDICTORS:
            if g != f:
                cols.append(f"a.{g}")
            elif g == "credit_history":
                cols.append(f"CAST(base.b_{g} AS DOUBLE) AS {g}")
            else:
                cols.append(f"base.b_{g} AS {g}")
        parts.append(f"SELECT a.application_id, '{f}' AS feature, {', '.join(cols)} FROM applications_v1 a CROSS JOIN base")
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + _baselines_sql() + f""",
orig AS (SELECT application_id, {probability_sql(sc)} AS p FROM feat),
v0 AS ({" UNION ALL ".join(parts)}),
v1 AS (SELECT *, coalesce(applicant_income, 0.0) + coalesce(coapplicant_income, 0.0) AS total_income FROM v0),
v2 AS (SELECT *, ln(1.0 + {clip_sql('total_income', 0.0)}) AS log_total_income,
              ln(1.0 + {clip_sql('loan_amount', 0.0)}) AS log_loan_amount FROM v1),
d AS (SELECT v2.application_id, v2.feature, orig.p - {probability_sql(sc)} AS delta
      FROM v2 JOIN orig USING (application_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY abs({fround_sql('delta', 9)}) DESC, feature ASC)
      AS rk FROM d)
SELECT application_id, CAST(rk AS BIGINT) AS rank, feature, round(delta, 6) AS delta FROM r WHERE rk <= {TOP_FACTORS}"""


def _encoded_sql() -> str:
    sc = DEFAULT_SCORECARD
    parts = []
    for f in sc.features:
        if f in sc.categorical:
            lv = f"CAST(CAST({f} AS INTEGER) AS VARCHAR)" if f == "credit_history" else f
            level = f"coalesce({lv}, 'Missing')"
        else:
            level = "'slope'"
        parts.append(f"SELECT '{f}' AS feature, {level} AS level, abs({contribution_sql(sc, f)}) AS imp FROM feat")
    return f",\nenc AS ({' UNION ALL '.join(parts)}),\nnrows AS (SELECT count(*) AS n_ FROM feat)"


def sql_importance_encoded() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + _encoded_sql() + """,
g AS (SELECT feature, level, sum(imp) / (SELECT n_ FROM nrows) AS importance FROM enc GROUP BY 1, 2),
t AS (SELECT sum(importance) AS t_ FROM g)
SELECT feature, level, round(importance, 6) AS importance,
  round(CASE WHEN t_ > 0 THEN importance / t_ ELSE 1.0 END, 6) AS share FROM g CROSS JOIN t"""


def sql_importance_rollup() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + _encoded_sql() + """,
g AS (SELECT feature, avg(imp) AS importance FROM enc GROUP BY 1),
t AS (SELECT sum(importance) AS t_ FROM g)
SELECT feature, round(importance, 6) AS importance,
  round(CASE WHEN t_ > 0 THEN importance / t_ ELSE 1.0 END, 6) AS share FROM g CROSS JOIN t"""


def _fold_sql() -> str:
    parts = [f"SELECT application_id, y, fold, '{sc.name}' AS model, {probability_sql(sc)} AS p FROM fl"
             for sc in CANDIDATES]
    return f""",
lab AS (SELECT *, CAST(trim(loan_status) = 'Y' AS INTEGER) AS y FROM feat),
fl AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {sp.order_key_sql('application_id', FOLD_SEED)},
                       application_id) - 1) % {FOLDS} AS INTEGER) AS fold FROM lab),
long AS ({" UNION ALL ".join(parts)}),
c AS (SELECT model, fold, count_if(y = 0 AND p < 0.5) AS tn, count_if(y = 0 AND p >= 0.5) AS fp,
             count_if(y = 1 AND p < 0.5) AS fn, count_if(y = 1 AND p >= 0.5) AS tp FROM long GROUP BY 1, 2),
rk AS (SELECT model, fold, y, rank() OVER (PARTITION BY model, fold ORDER BY p)
              + (count(*) OVER (PARTITION BY model, fold, p) - 1) / 2.0 AS ar FROM long),
au AS (SELECT model, fold, (sum(CASE WHEN y = 1 THEN ar ELSE 0 END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * count_if(y = 0)) AS auc FROM rk GROUP BY 1, 2),
fm AS (SELECT c.model, c.fold,
         (tp + tn) / (tp + tn + fp + fn) AS accuracy,
         ((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
          + (CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END)) / 2.0 AS balanced_accuracy,
         au.auc,
         CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) > 0
              THEN 2 * (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) * (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
                   / ((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END))
              ELSE 0.0 END AS f1
       FROM c JOIN au USING (model, fold)),
lb AS (SELECT model, avg(auc) AS auc_key, avg(balanced_accuracy) AS balanced_key, """ + ", ".join(
        f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std"
        for m in ("accuracy", "balanced_accuracy", "auc", "f1")) + " FROM fm GROUP BY model)"


def sql_leaderboard() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + _fold_sql() + "\nSELECT * EXCLUDE (auc_key, balanced_key) FROM lb"


def sql_champion() -> str:
    fam = ", ".join(f"'{m}'" for m in CHAMPION_FAMILY)
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + _fold_sql() + f"""
SELECT * EXCLUDE (auc_key, balanced_key) FROM lb WHERE model IN ({fam})
ORDER BY auc_key DESC, balanced_key DESC, model ASC LIMIT 1"""


def sql_blend_search() -> str:
    grid = bl.weight_grid(len(CANDIDATES))
    wvals = ", ".join(f"({i}, " + ", ".join(f"{k / bl.WEIGHT_STEPS!r}::DOUBLE" for k in ks) + ")" for i, ks in enumerate(grid))
    wcols = ", ".join(f"w{j + 1}" for j in range(len(CANDIDATES)))
    tvals = ", ".join(f"({j}, {t!r}::DOUBLE)" for j, t in enumerate(bl.THRESHOLDS))
    blend = " + ".join(f"w{j + 1} * p_{sc.name}" for j, sc in enumerate(CANDIDATES))
    pcols = ", ".join(f"{probability_sql(sc)} AS p_{sc.name}" for sc in CANDIDATES)
    rec1 = "(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)"
    rec0 = "(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END)"
    return "WITH " + SQL_APPLICATIONS_V1 + _FEAT_SQL + f""",
lab AS (SELECT *, CAST(trim(loan_status) = 'Y' AS INTEGER) AS y FROM feat),
rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sp.order_key_sql('application_id', SPLIT_SEED)},
                 application_id) - 1 AS rn, count(*) OVER (PARTITION BY y) AS n FROM lab),
dev AS (SELECT y, {pcols} FROM rk WHERE NOT (rn < floor(n * {TEST_SIZE} + 0.5))),
w AS (SELECT * FROM (VALUES {wvals}) AS t(wid, {wcols})),
th AS (SELECT * FROM (VALUES {tvals}) AS t(j, threshold)),
bp AS (SELECT w.wid, dev.y, {blend} AS p FROM dev CROSS JOIN w),
cnt AS (SELECT wid, j, threshold, count_if(y = 1 AND p >= threshold) AS tp, count_if(y = 0 AND p < threshold) AS tn,
               count_if(y = 1 AND p < threshold) AS fn, count_if(y = 0 AND p >= threshold) AS fp
        FROM bp CROSS JOIN th GROUP BY 1, 2, 3),
m AS (SELECT wid, j, threshold, (tp + tn) / (tp + tn + fp + fn) AS accuracy, ({rec1} + {rec0}) / 2.0 AS balanced_accuracy
      FROM cnt),
ar AS (SELECT wid, y, rank() OVER (PARTITION BY wid ORDER BY p) + (count(*) OVER (PARTITION BY wid, p) - 1) / 2.0 AS r
       FROM bp),
au AS (SELECT wid, (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * count_if(y = 0)) AS auc FROM ar GROUP BY wid),
best AS (SELECT m.*, au.auc FROM m JOIN au USING (wid)
         ORDER BY accuracy DESC, balanced_accuracy DESC, auc DESC, abs(threshold - 0.5) ASC, wid ASC, j ASC LIMIT 1)
SELECT {wcols}, threshold, {fround_sql('accuracy', 9)} AS accuracy, {fround_sql('balanced_accuracy', 9)} AS balanced_accuracy,
  {fround_sql('auc', 9)} AS auc
FROM best JOIN w USING (wid)"""


QUERIES = {
    "scorecard_scores": (scorecard_scores, sql_scorecard_scores),
    "scorecard_factors": (scorecard_factors, sql_scorecard_factors),
    "ensemble_scores": (ensemble_scores, sql_ensemble_scores),
    "local_sensitivity": (local_sensitivity, sql_local_sensitivity),
    "importance_encoded": (importance_encoded, sql_importance_encoded),
    "importance_rollup": (importance_rollup, sql_importance_rollup),
    "leaderboard": (leaderboard, sql_leaderboard),
    "champion": (champion, sql_champion),
    "blend_search": (blend_search, sql_blend_search),
}


# ------------------------------------------------------------ permutation

PERMUTATION_REPEATS = 3


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop in holdout accuracy when one raw predictor is permuted, mean and
    population std over repeats.  Every (feature f, repeat r) has a permutation
    of its own: the row at position i in id order receives f from the row at
    position i in md5(id:f:r) order.  Only narrow donor rows (one value) are
    ranked and shuffled; they are pivoted to one row per (repeat, position),
    which joins each holdout row once per repeat, and the ten variants of a
    row are scored as columns.  All orders are distributed ranks."""
    import uuid

    from ..operators.globalrank import running_before, value_counts
    from ..session import materialize
    sc = DEFAULT_SCORECARD
    b = applications_v1(spark, sf_dir).withColumn("y", (F.trim(F.col("loan_status")) == "Y").cast("int"))
    s = sp.stratified_split(b.select("application_id", "y"), "application_id", "y", TEST_SIZE, SPLIT_SEED)
    t = b.join(s.where(F.col("split") == "test").select("application_id"), "application_id")
    ids = running_before(value_counts(t, "application_id"), "application_id", ["_cnt"])
    t = t.join(ids.select("application_id", F.col("_cnt_before").alias("pos")), "application_id")
    t = materialize(t, "permutation_holdout", (uuid.uuid4().hex,))
    reps = [F.lit(r) for r in range(PERMUTATION_REPEATS)]
    text = {f for f, kind in t.dtypes if kind == "string"}
    donors = [F.struct(F.lit(f).alias("feature"), r.alias("repeat"),
                       (F.col(f) if f in text else F.lit(None).cast("string")).alias("s"),
                       (F.lit(None).cast("double") if f in text else F.col(f).cast("double")).alias("d"))
              for f in V1_PREDICTORS for r in reps]
    narrow = (t.select("application_id", F.explode(F.array(*donors)).alias("e")).select("application_id", "e.*")
              .withColumn("_pid", F.concat_ws(":", F.col("application_id").cast("string"), "feature",
                                              F.col("repeat").cast("string")))
              .withColumn("_of", F.concat_ws(":", "feature", F.col("repeat").cast("string"))))
    ranked = sp.stratified_rank(narrow, "_pid", "_of", "perm")
    pivot = ranked.groupBy("repeat", F.col("_rank").alias("pos")).agg(
        *[F.max(F.when(F.col("feature") == f, F.col("s" if f in text else "d"))).alias(f"d_{f}") for f in V1_PREDICTORS])
    x = (t.select("pos", "y", *V1_PREDICTORS, F.explode(F.array(*reps)).alias("repeat"))
         .join(pivot, ["repeat", "pos"]))

    def right(cols):
        total = F.coalesce(cols["applicant_income"], F.lit(0.0)) + F.coalesce(cols["coapplicant_income"], F.lit(0.0))
        loan = cols["loan_amount"]
        cols = dict(cols, log_total_income=F.log(F.lit(1.0) + F.when(total < 0, F.lit(0.0)).otherwise(total)),
                    log_loan_amount=F.log(F.lit(1.0) + F.when(loan < 0, F.lit(0.0)).otherwise(loan)))
        return (_probability_of(sc, cols) >= 0.5).cast("int") == F.col("y")

    own = {g: F.col(g) for g in V1_PREDICTORS}
    counts = x.groupBy("repeat").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(right(own)).alias("bc"),
        *[F.count_if(right(dict(own, **{f: F.col(f"d_{f}")}))).alias(f"c_{f}") for f in V1_PREDICTORS])
    per = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"c_{f}").alias("c")) for f in V1_PREDICTORS])
    # drops as integer counts: the mean is exact in any engine
    d = counts.select("n", "bc", F.explode(per).alias("e")).select("e.feature", "n", (F.col("bc") - F.col("e.c")).alias("dc"))
    out = d.groupBy("feature").agg((F.sum("dc") / (F.count(F.lit(1)) * F.max("n"))).alias("m"),
                                   F.stddev_pop(F.col("dc") / F.col("n")).alias("s"))
    return (out.select("feature", (F.round("m", 6) + F.lit(0.0)).alias("importance_mean"),
                       (F.round("s", 6) + F.lit(0.0)).alias("importance_std"))
            .orderBy(F.col("importance_mean").desc(), "feature"))


def sql_permutation_importance() -> str:
    sc = DEFAULT_SCORECARD
    combos = ", ".join(f"('{f}', {r})" for f in V1_PREDICTORS for r in range(PERMUTATION_REPEATS))
    dcols = ", ".join(f"{g} AS d_{g}" for g in V1_PREDICTORS)
    rcols = ", ".join(f"CASE WHEN x.feature = '{g}' THEN d.d_{g} ELSE x.{g} END AS {g}" for g in V1_PREDICTORS)
    pid = "CAST(application_id AS VARCHAR) || ':' || feature || ':' || CAST(repeat AS VARCHAR)"
    pkey = f"('0x' || substr(md5({pid} || ':perm'), 1, 15))::BIGINT"
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT *, CAST(trim(loan_status) = 'Y' AS INTEGER) AS y FROM applications_v1),
rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sp.order_key_sql('application_id', SPLIT_SEED)},
                 application_id) - 1 AS rn, count(*) OVER (PARTITION BY y) AS n FROM lab),
t AS (SELECT * EXCLUDE (rn, n), row_number() OVER (ORDER BY application_id) - 1 AS pos
      FROM rk WHERE rn < floor(n * {TEST_SIZE} + 0.5)),
combos AS (SELECT * FROM (VALUES {combos}) AS c(feature, repeat)),
x AS (SELECT t.*, c.feature, c.repeat FROM t CROSS JOIN combos c),
d AS (SELECT feature, repeat, row_number() OVER (PARTITION BY feature, repeat ORDER BY {pkey}, {pid}) - 1 AS pos, {dcols}
      FROM x),
rec AS (SELECT x.feature, x.repeat, x.y, {rcols} FROM x JOIN d USING (feature, repeat, pos)),
rf1 AS (SELECT *, coalesce(applicant_income, 0.0) + coalesce(coapplicant_income, 0.0) AS total_income FROM rec),
rf AS (SELECT *, ln(1.0 + {clip_sql('total_income', 0.0)}) AS log_total_income,
              ln(1.0 + {clip_sql('loan_amount', 0.0)}) AS log_loan_amount FROM rf1),
acc AS (SELECT feature, repeat, count_if(CAST({probability_sql(sc)} >= 0.5 AS INTEGER) = y) AS c, count(*) AS n
        FROM rf GROUP BY 1, 2),
tf1 AS (SELECT *, coalesce(applicant_income, 0.0) + coalesce(coapplicant_income, 0.0) AS total_income FROM t),
tf AS (SELECT *, ln(1.0 + {clip_sql('total_income', 0.0)}) AS log_total_income,
              ln(1.0 + {clip_sql('loan_amount', 0.0)}) AS log_loan_amount FROM tf1),
base AS (SELECT count_if(CAST({probability_sql(sc)} >= 0.5 AS INTEGER) = y) AS bc FROM tf)
SELECT feature, round(sum(bc - c) / (count(*) * max(n)), 6) + 0.0 AS importance_mean,
       round(stddev_pop((bc - c) / n), 6) + 0.0 AS importance_std
FROM acc CROSS JOIN base GROUP BY feature"""


QUERIES["permutation_importance"] = (permutation_importance, sql_permutation_importance)
