"""Cleaning of the v2 application layout (names, text, numbers, labels,
clipping with correction counts, duplicate removal, report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.fixtures import ASSET_COLUMNS

TEXT_COLUMNS = ["education", "self_employed", "loan_status"]
NUMERIC_COLUMNS = ["no_of_dependents", "income_annum", "loan_amount", "loan_term", "cibil_score",
                   *ASSET_COLUMNS]
DEDUP_SUBSET = ["no_of_dependents", "education", "self_employed", "income_annum", "loan_amount",
                "loan_term", "cibil_score", *ASSET_COLUMNS, "loan_status"]
# Label mapping.
TARGET_MAP = {"Approved": 1, "Rejected": 0}


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def normalize(df: DataFrame) -> DataFrame:
    """Names stripped and lower-cased, text trimmed, numbers coerced
    (unparseable -> NULL, never an error), target mapped."""
    df = normalize_names(df)
    cols = []
    for c in df.columns:
        if c in TEXT_COLUMNS:
            cols.append(F.trim(F.col(c).cast("string")).alias(c))
        elif c in NUMERIC_COLUMNS:
            cols.append(F.col(c).try_cast("double").alias(c))
        else:
            cols.append(F.col(c))
    df = df.select(*cols)
    if "loan_status" in df.columns:
        df = df.withColumn("target", target())
    return df


def target():
    t = F.lit(None).cast("int")
    for k, v in TARGET_MAP.items():
        t = F.when(F.col("loan_status") == k, F.lit(v)).otherwise(t)
    return t


def clip_assets(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)).alias(c) if c in ASSET_COLUMNS
                       else F.col(c) for c in df.columns])


def deduplicate(df: DataFrame, subset, order_col: str, derived: dict | None = None) -> DataFrame:
    """Keep the first row (smallest ``order_col``) of each group of rows equal
    on ``subset`` (NULL equals NULL).  An aggregate with map-side partial
    aggregation, so a group holding a third of the table is combined before
    the shuffle instead of landing in one task.  ``derived``: columns that are
    functions of the subset, with their expressions."""
    derived = derived or {}
    others = [c for c in df.columns if c not in subset and c not in derived]
    if others == [order_col]:
        # a minimum of a number is a hash aggregate; what derives from the
        # subset is computed again from it
        g = df.groupBy(*subset).agg(F.min(order_col).alias(order_col))
        return g.withColumns(derived).select(*df.columns)
    others += list(derived)
    keep = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_k")
    g = df.groupBy(*subset).agg(keep)
    return g.select(*[F.col(c) for c in subset], "_k.*").select(*df.columns)


def clean_v2(raw: DataFrame, id_col: str = "loan_id") -> DataFrame:
    return _distinct(normalize(raw), id_col)


def _distinct(n: DataFrame, id_col: str) -> DataFrame:
    derived = {"target": target()} if "loan_status" in n.columns else {}
    return deduplicate(clip_assets(n), [c for c in DEDUP_SUBSET if c in n.columns], id_col, derived)


def clean_v2_report(raw: DataFrame, id_col: str = "loan_id") -> DataFrame:
    """(metric, field, value): rows before / after, duplicates removed,
    negative values clipped per asset column (counted before de-duplication)
    and missing values per column after it (only non-zero)."""
    n = normalize(raw)
    before = n.agg(F.count(F.lit(1)).alias("rows_before"),
                   *[F.count_if(F.col(c) < 0).alias(f"neg_{c}") for c in ASSET_COLUMNS])
    cleaned = _distinct(n, id_col)
    after = cleaned.agg(F.count(F.lit(1)).alias("rows_after"),
                        *[F.count_if(F.col(c).isNull()).alias(f"miss_{c}") for c in cleaned.columns])
    one = before.crossJoin(after)
    parts = [("rows_before_deduplication", "", F.col("rows_before")),
             ("rows", "", F.col("rows_after")),
             ("duplicate_feature_rows_removed", "", F.col("rows_before") - F.col("rows_after"))]
    parts += [("negative_asset_values_clipped", c, F.col(f"neg_{c}")) for c in ASSET_COLUMNS]
    parts += [("missing_values", c, F.col(f"miss_{c}")) for c in cleaned.columns]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(f).alias("field"),
                              v.cast("long").alias("value")) for m, f, v in parts])
    out = one.select(F.explode(rows).alias("r")).select("r.*")
    return out.where((F.col("metric") != "missing_values") | (F.col("value") > 0))
