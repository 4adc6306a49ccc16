"""Data-quality and exploratory profiles (all distributed aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .globalrank import exact_quantiles


def quality_profile(df: DataFrame, id_col: str, label_approved) -> DataFrame:
    """rows, columns, duplicate rows, duplicate ids, missing cells, approval
    rate.  Equal rows have equal ids: ids are counted first (one column), and
    only rows of repeated ids are compared as a whole."""
    cols = df.columns
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
    dup_ids = ids.agg(F.sum(F.col("c") - 1).alias("duplicate_ids"))
    repeated = ids.where("c > 1").select(F.col(id_col).alias("_id"))
    suspects = df.join(repeated, F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")
    dup_rows = suspects.groupBy(*cols).agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum(F.col("c") - 1).alias("duplicate_rows"))
    base = df.agg(F.count(F.lit(1)).alias("rows"),
                  sum(F.count_if(F.col(c).isNull()) for c in cols).alias("missing_cells"),
                  F.round(F.avg(F.when(label_approved, 1.0).otherwise(0.0)), 6).alias("historical_approval_rate"))
    return (base.crossJoin(dup_rows).crossJoin(dup_ids)
            .select(F.col("rows").cast("long"), F.lit(len(cols)).cast("long").alias("columns"),
                    F.coalesce(F.col("duplicate_rows"), F.lit(0)).cast("long").alias("duplicate_rows"),
                    F.coalesce(F.col("duplicate_ids"), F.lit(0)).cast("long").alias("duplicate_ids"),
                    F.col("missing_cells").cast("long"), "historical_approval_rate"))


def missing_by_field(df: DataFrame) -> DataFrame:
    """(field, missing, rate) for fields with at least one null, desc."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}")
                                                  for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"m{i}").cast("long").alias("missing"))
                     for i, c in enumerate(cols)])
    out = a.select("_n", F.explode(rows).alias("r")).select("r.*", "_n")
    return (out.where(F.col("missing") > 0)
               .select("field", "missing", F.round(F.col("missing") / F.col("_n"), 6).alias("rate"))
               .orderBy(F.col("missing").desc(), "field"))


def value_counts(df: DataFrame, col: str, labels: dict | None = None) -> DataFrame:
    v = F.col(col)
    if labels:
        m = F.lit(None).cast("string")
        for k, lab in labels.items():
            m = F.when(v == k, F.lit(lab)).otherwise(m)
        v = m
    return (df.groupBy(F.coalesce(v.cast("string"), F.lit("Missing")).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "value"))


def approval_by(df: DataFrame, columns, label_approved) -> DataFrame:
    """Approval percentage (1 place) by each column, null as 'Missing', in one
    aggregation over (column, value) pairs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("value"))
                                for c in columns]))
    x = df.select(pairs.alias("p"), F.when(label_approved, 1.0).otherwise(0.0).alias("_y"))
    return (x.groupBy(F.col("p.column").alias("column"), F.col("p.value").alias("value"))
              .agg(F.count(F.lit(1)).alias("applications"),
                   F.round(F.avg("_y") * 100, 1).alias("approval_pct"))
              .orderBy("column", F.col("approval_pct").desc(), "value"))


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, sample std, min, exact quartiles (linear interpolation)
    and max per column, one row per column.  Long form (column, value) so
    every statistic is a grouped aggregate; quartiles via distributed ranks."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(c).cast("double").alias("value"))
                                         for c in columns])).alias("p")).select("p.*")
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"])
    qw = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                    for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    out = basic.join(qw, "column", "left")
    return out.select("column", F.col("count").cast("long"),
                      *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def row_fingerprint(df: DataFrame, cols) -> DataFrame:
    """Order-free fingerprint: row count and sum of a 60-bit md5 prefix of each
    row's canonical text (every value with its length, so values can't run into
    each other).  Equal for any partitioning or file order."""
    def value(c):
        s = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    h = F.conv(F.substring(F.md5(F.concat(*[value(c) for c in cols])), 1, 15), 16, 10)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def canonical_sql(texts: list[str]) -> str:
    """The canonical text of a row for DuckDB, from its columns as text."""
    return " || ".join(f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts)
