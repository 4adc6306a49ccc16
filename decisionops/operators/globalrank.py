"""Global order statistics without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row into one task.  The
helpers here rank *distinct* values instead, in three distributed steps:

1. per (group, value) counts / measure sums (partial aggregation, then a
   shuffle on the value);
2. a monotone bucket id per value; bucket totals form a small table whose
   size is bounded by construction (log-scale buckets: at most
   ``2 * 64 * 2100`` for any double; fixed-width buckets for [0, 1] scores);
   its running sums are broadcast;
3. a window *inside* each bucket adds the in-bucket running sum.

The result gives, for each distinct value, the sum of each measure over all
strictly smaller values, from which exact quantiles (linear interpolation),
average-tie percent ranks and rank-sum AUC follow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOG_STEPS = 64          # buckets per octave
_LOG_OFFSET = 200000     # keeps positive and negative keys apart


def log_bucket(v: Column) -> Column:
    """Monotone bucket id for any finite double (non-decreasing in v)."""
    mag = F.floor(F.log2(F.abs(v)) * _LOG_STEPS) + _LOG_OFFSET
    return (F.when(v > 0, mag).when(v < 0, -mag).otherwise(F.lit(0))).cast("long")


def unit_bucket(v: Column, width: int = 4096) -> Column:
    """Fixed-width buckets for values in [0, 1] (scores, probabilities)."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) * width).cast("long")


def running_before(counts: DataFrame, value_col: str, measures: list[str],
                   group_cols: list[str] | None = None, bucket=log_bucket) -> DataFrame:
    """For a table with one row per (group, value), add ``<m>_before`` =
    sum of m over strictly smaller values in the same group, and
    ``<m>_total`` = group total."""
    group_cols = list(group_cols or [])
    t = counts.withColumn("_bkt", bucket(F.col(value_col)))
    bt = t.groupBy(*group_cols, "_bkt").agg(*[F.sum(m).alias(f"_b_{m}") for m in measures])
    wb = Window.partitionBy(*group_cols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*group_cols)
    bt = bt.select(
        *group_cols, "_bkt",
        *[F.coalesce(F.sum(f"_b_{m}").over(wb), F.lit(0)).alias(f"_bs_{m}") for m in measures],
        *[F.sum(f"_b_{m}").over(wall).alias(f"{m}_total") for m in measures],
    )
    # bt has one row per (group, bucket): bounded by the bucket scheme.
    t = t.join(F.broadcast(bt), [*group_cols, "_bkt"])
    wi = Window.partitionBy(*group_cols, "_bkt").orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    return t.select(
        *[c for c in counts.columns],
        *[(F.col(f"_bs_{m}") + F.coalesce(F.sum(m).over(wi), F.lit(0))).alias(f"{m}_before")
          for m in measures],
        *[F.col(f"{m}_total") for m in measures],
    )


def value_counts(df: DataFrame, value_col: str, group_cols: list[str] | None = None) -> DataFrame:
    group_cols = list(group_cols or [])
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_cnt")))


def exact_quantiles(df: DataFrame, value_col: str, qs: list[float],
                    group_cols: list[str] | None = None, bucket=log_bucket) -> DataFrame:
    """Exact, linearly interpolated quantiles (numpy/pandas default).

    Returns (group..., q, value).  Nulls are ignored; an all-null group
    yields no row."""
    return quantiles_from_counts(value_counts(df, value_col, group_cols), value_col, qs,
                                 group_cols, bucket)


def quantiles_from_counts(counts: DataFrame, value_col: str, qs: list[float],
                          group_cols: list[str] | None = None, bucket=log_bucket) -> DataFrame:
    """As ``exact_quantiles`` from a (group..., value, _cnt) table with
    non-null values."""
    group_cols = list(group_cols or [])
    r = running_before(counts, value_col, ["_cnt"], group_cols, bucket)
    qdf = counts.sparkSession.createDataFrame([(float(q),) for q in qs], "q double")
    # every distinct value joins at most the quantile positions it covers
    r = r.crossJoin(F.broadcast(qdf))
    h = F.col("q") * (F.col("_cnt_total") - 1)
    lo_k, hi_k = F.floor(h), F.ceil(h)
    covers = lambda k: (F.col("_cnt_before") <= k) & (k < F.col("_cnt_before") + F.col("_cnt"))
    r = r.where(covers(lo_k) | covers(hi_k))
    agg = r.groupBy(*group_cols, "q").agg(
        F.max(F.when(covers(lo_k), F.col(value_col))).alias("_vlo"),
        F.max(F.when(covers(hi_k), F.col(value_col))).alias("_vhi"),
        F.first(h - lo_k).alias("_frac"),
    )
    val = F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))
    return agg.select(*group_cols, "q", F.when(F.col("_frac") == 0, F.col("_vlo"))
                      .otherwise(val).alias("value"))


def exact_median(df: DataFrame, value_col: str, alias: str = "median") -> DataFrame:
    """One-row table with the exact interpolated median (null if no values)."""
    q = exact_quantiles(df, value_col, [0.5])
    one = df.sparkSession.range(1).select(F.lit(0.5).alias("q"))
    return one.join(q, "q", "left").select(F.col("value").alias(alias))


HOT_SHARE = 1000         # a value held by over a thousandth of a group's rows is hot


def percent_rank_avg(df: DataFrame, value_col: str, out_col: str = "pct_rank",
                     group_cols: list[str] | None = None, bucket=log_bucket) -> DataFrame:
    """pandas ``rank(pct=True)``: ties get their average rank, divided by the
    number of non-null values; null values get 0 (``fillna(0)``).

    Rows take their rank by value.  The hot values (fewer than ``HOT_SHARE`` a
    group) are broadcast, so their rows and those without a value stay where they
    are; the other rows are joined by value, of which none is hot."""
    keys = [*(group_cols or []), value_col]
    r = running_before(value_counts(df, value_col, group_cols), value_col, ["_cnt"], group_cols, bucket)
    r = r.select(*keys, (F.col("_cnt") * HOT_SHARE > F.col("_cnt_total")).alias("_is_hot"),
                 ((F.col("_cnt_before") + (F.col("_cnt") + 1) / 2.0) / F.col("_cnt_total")).alias(out_col))
    r = materialize(r, "percent_ranks", (uuid.uuid4().hex,))        # a row a distinct value, read twice
    hot = r.where("_is_hot").select(*keys, F.col(out_col).alias("_hot"))
    tagged = df.join(F.broadcast(hot), keys, "left")
    placed = F.col("_hot").isNotNull() | F.col(value_col).isNull()
    direct = tagged.where(placed).withColumn(out_col, F.coalesce("_hot", F.lit(0.0)))
    rest = tagged.where(~placed).join(r.where("NOT _is_hot").drop("_is_hot"), keys, "left")
    columns = [*df.columns, out_col]
    return direct.select(columns).unionByName(
        rest.withColumn(out_col, F.coalesce(out_col, F.lit(0.0))).select(columns))


def rank_sum_auc(df: DataFrame, score_col: str, label_col: str,
                 group_cols: list[str] | None = None, bucket=unit_bucket) -> DataFrame:
    """ROC-AUC with half credit for tied scores (Mann-Whitney U / (P*N)).

    Returns (group..., auc); null when a group lacks one of the classes."""
    group_cols = list(group_cols or [])
    pos = F.col(label_col) == 1
    counts = (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(*group_cols, score_col)
              .agg(F.count_if(pos).alias("_pos"), F.count_if(~pos).alias("_neg")))
    r = running_before(counts, score_col, ["_neg", "_pos"], group_cols, bucket)
    part = (F.col("_pos") * (F.col("_neg_before") + F.col("_neg") / 2.0))
    out = r.groupBy(*group_cols).agg(
        F.sum(part).alias("_u"), F.first("_pos_total").alias("_p"), F.first("_neg_total").alias("_n"))
    return out.select(*group_cols, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                          F.col("_u") / (F.col("_p") * F.col("_n"))).alias("auc"))

