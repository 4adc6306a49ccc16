"""Row and dataset validation as bulk DataFrame jobs.

Row rules are boolean Columns; each row gets the list of rules it breaks
(``violations``), so valid rows and a quarantine split come from one pass.
Dataset checks (required columns, row-count guards, label domain, unknown
fields) produce ``(check, passed, detail)`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field domains and ranges of the two application layouts.
V1_RULES = {
    "married": ("enum", ["Yes", "No"], "Yes"),
    "dependents": ("enum", ["0", "1", "2", "3+"], "0"),
    "education": ("enum", ["Graduate", "Not Graduate"], "Graduate"),
    "self_employed": ("enum", ["Yes", "No"], "No"),
    "applicant_income": ("range", (0.0, True, 1_000_000.0), None),
    "coapplicant_income": ("range", (0.0, True, 1_000_000.0), 0.0),
    "loan_amount": ("range", (0.0, False, 10_000.0), None),
    "loan_amount_term": ("range", (0.0, False, 600.0), 360.0),
    "credit_history": ("enum_num", [0.0, 1.0], 1.0),
    "property_area": ("enum", ["Rural", "Semiurban", "Urban"], "Urban"),
}
V2_RULES = {
    "no_of_dependents": ("int_range", (0, 10), 0),
    "education": ("enum", ["Graduate", "Not Graduate"], "Graduate"),
    "self_employed": ("enum", ["Yes", "No"], "No"),
    "income_annum": ("range", (0.0, False, 100_000_000.0), None),
    "loan_amount": ("range", (0.0, False, 200_000_000.0), None),
    "loan_term": ("range", (0.0, False, 40.0), None),
    "cibil_score": ("int_range", (300, 900), None),
    "residential_assets_value": ("range", (0.0, True, 500_000_000.0), 0.0),
    "commercial_assets_value": ("range", (0.0, True, 500_000_000.0), 0.0),
    "luxury_assets_value": ("range", (0.0, True, 500_000_000.0), 0.0),
    "bank_asset_value": ("range", (0.0, True, 500_000_000.0), 0.0),
}
SEGMENT_DIMENSIONS = ["channel", "property_area", "education", "self_employed", "credit_history"]


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def rule_ok(name: str, spec) -> Column:
    """True when the value obeys the rule; an explicit NULL fails."""
    kind, arg = spec[0], spec[1]
    c = F.col(name)
    if kind == "enum":
        s = F.trim(c.cast("string"))
        return F.coalesce(s.isin(*arg), F.lit(False))
    if kind == "enum_num":
        x = c.try_cast("double")
        return F.coalesce(x.isin(*arg), F.lit(False))
    x = c.try_cast("double")
    if kind == "int_range":
        lo, hi = arg
        ok = (x >= lo) & (x <= hi) & (x == F.floor(x))
    else:
        lo, lo_incl, hi = arg
        ok = ((x >= lo) if lo_incl else (x > lo)) & (x <= hi) & _finite(x)
    return F.coalesce(ok, F.lit(False))


def with_defaults(df: DataFrame, rules: dict) -> DataFrame:
    """Add absent optional columns with their default (present NULLs stay)."""
    for name, spec in rules.items():
        if name not in df.columns and spec[2] is not None:
            df = df.withColumn(name, F.lit(spec[2]))
    return df


def validate_rows(df: DataFrame, rules: dict, id_col: str) -> DataFrame:
    """(id, violation_count, violations, valid).  ``violations`` lists the
    failing fields in rule order, comma separated."""
    df = with_defaults(df, rules)
    fails = F.array_compact(F.array(*[F.when(~rule_ok(n, s), F.lit(n)) for n, s in rules.items()]))
    return df.select(
        id_col,
        F.size(fails).cast("long").alias("violation_count"),
        F.array_join(fails, ",").alias("violations"),
        (F.size(fails) == 0).alias("valid"))


def scenario_violations(scenarios: DataFrame, dimension_col: str = "segment_dimension") -> DataFrame:
    c = F.col
    checks = [
        ("approve_threshold", (c("approve_threshold") > 0.5) & (c("approve_threshold") < 1.0)),
        ("reject_threshold", (c("reject_threshold") > 0.0) & (c("reject_threshold") < 0.5)),
        ("threshold_order", c("reject_threshold") < c("approve_threshold")),
        ("analysts", (c("analysts") >= 1) & (c("analysts") <= 500)),
        ("productive_hours", (c("productive_hours") > 0.5) & (c("productive_hours") <= 12.0)),
        ("volume_multiplier", (c("volume_multiplier") > 0.1) & (c("volume_multiplier") <= 10.0)),
        ("segment_dimension", c(dimension_col).isin(*SEGMENT_DIMENSIONS)),
    ]
    fails = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks]))
    return scenarios.select("*", F.array_join(fails, ",").alias("violations"),
                            (F.size(fails) == 0).alias("valid"))


@dataclass(frozen=True)
class Expectation:
    name: str
    required: tuple
    min_rows: int = 0
    exact_rows: int | None = None
    min_usable: int = 0                # rows with a known label
    label_col: str | None = None
    allowed_labels: tuple = ()
    forbidden: tuple = ()
    optional: tuple | None = None      # given: columns beyond required and optional are refused


def dataset_checks(df: DataFrame, exp: Expectation) -> DataFrame:
    """Dataset contract as rows (check, passed, detail).  Column checks read
    the schema on the driver; data checks are one aggregate.  Every unexpected
    label gets a row of its own, with its count."""
    spark = df.sparkSession
    missing = sorted(set(exp.required) - set(df.columns))
    forbidden = sorted(set(exp.forbidden) & set(df.columns))
    rows = [(f"{exp.name}.required_columns", not missing, ",".join(missing)),
            (f"{exp.name}.forbidden_columns", not forbidden, ",".join(forbidden))]
    if exp.optional is not None:
        unknown = sorted(set(df.columns) - set(exp.required) - set(exp.optional))
        rows.append((f"{exp.name}.unknown_columns", not unknown, ",".join(unknown)))
    meta = spark.createDataFrame(rows, "check string, passed boolean, detail string")
    aggs = [F.count(F.lit(1)).alias("_n")]
    if exp.label_col:
        lab = F.trim(F.col(exp.label_col))
        bad = lab.isNotNull() & ~lab.isin(*exp.allowed_labels)
        aggs.append(F.count_if(bad).alias("_bad"))
        aggs.append(F.count_if(~F.coalesce(lab.isin(*exp.allowed_labels), F.lit(False))).alias("_unmapped"))
    a = df.agg(*aggs)
    n_ok = F.col("_n") >= exp.min_rows
    if exp.exact_rows is not None:
        n_ok = n_ok & (F.col("_n") == exp.exact_rows)
    parts = [F.struct(F.lit(f"{exp.name}.row_count").alias("check"), n_ok.alias("passed"),
                      F.col("_n").cast("string").alias("detail"))]
    if exp.label_col:
        usable = F.col("_n") - F.col("_unmapped")
        parts.append(F.struct(F.lit(f"{exp.name}.usable_rows").alias("check"), (usable >= exp.min_usable).alias("passed"),
                              usable.cast("string").alias("detail")))
        parts.append(F.struct(F.lit(f"{exp.name}.label_domain").alias("check"), (F.col("_bad") == 0).alias("passed"),
                              F.col("_bad").cast("string").alias("detail")))
        parts.append(F.struct(F.lit(f"{exp.name}.unmapped_labels").alias("check"),
                              (F.col("_unmapped") == 0).alias("passed"),
                              F.col("_unmapped").cast("string").alias("detail")))
    data = meta.unionByName(a.select(F.explode(F.array(*parts)).alias("r")).select("r.*"))
    if exp.label_col:
        data = data.unionByName(df.where(bad).groupBy(lab.alias("_l")).count().select(
            F.lit(f"{exp.name}.unexpected_label").alias("check"), F.lit(False).alias("passed"),
            F.concat_ws(": ", "_l", F.col("count").cast("string")).alias("detail")))
    return data
