"""Stable stratified holdout and k-fold assignment.

Rows are ordered inside their stratum by a 60-bit md5 key of ``id:seed``,
so membership depends only on the row and the seed -- never on the number
of partitions.  The rank inside a stratum is computed without a
stratum-wide window: the top 12 key bits form 4096 buckets per stratum
(uniform, so no bucket is hot even when one stratum holds most rows);
bucket counts are a small table whose running sums are broadcast, and a
window runs only inside (stratum, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET_SHIFT = 48       # 60-bit key -> 4096 buckets


def order_key(id_col: str, seed) -> Column:
    text = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def order_key_sql(id_col: str, seed) -> str:
    return f"('0x' || substr(md5(CAST({id_col} AS VARCHAR) || ':{seed}'), 1, 15))::BIGINT"


def stratified_rank(df: DataFrame, id_col: str, strata_col: str, seed) -> DataFrame:
    """Adds ``_rank`` (0-based position inside the stratum by (key, id)) and
    ``_n`` (stratum size)."""
    t = df.withColumn("_key", order_key(id_col, seed)).withColumn("_bkt", F.shiftright("_key", _BUCKET_SHIFT))
    bt = t.groupBy(strata_col, "_bkt").agg(F.count(F.lit(1)).alias("_bc"))
    wb = Window.partitionBy(strata_col).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(strata_col, "_bkt", F.coalesce(F.sum("_bc").over(wb), F.lit(0)).alias("_bstart"),
                   F.sum("_bc").over(Window.partitionBy(strata_col)).alias("_n"))
    t = t.join(F.broadcast(bt), [strata_col, "_bkt"])     # <= strata x 4096 rows
    wi = Window.partitionBy(strata_col, "_bkt").orderBy("_key", id_col)
    return t.withColumn("_rank", F.col("_bstart") + F.row_number().over(wi) - 1).drop("_bkt", "_bstart")


def stratified_split(df: DataFrame, id_col: str, label_col: str, test_size: float = 0.2,
                     seed=2026) -> DataFrame:
    """``split`` = 'test' for the first round(test_size * n) rows of each
    label by key order, else 'dev'."""
    r = stratified_rank(df, id_col, label_col, seed)
    n_test = F.floor(F.col("_n") * test_size + 0.5)
    return r.withColumn("split", F.when(F.col("_rank") < n_test, "test").otherwise("dev")) \
            .drop("_key", "_rank", "_n")


def stratified_folds(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed=42) -> DataFrame:
    """``fold`` = rank inside the label modulo k: fold sizes differ by at most
    one per label (the stratified k-fold contract)."""
    r = stratified_rank(df, id_col, label_col, seed)
    return r.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_key", "_rank", "_n")


def repeated_folds(df: DataFrame, id_col: str, label_col: str, k: int = 5, repeats: int = 3,
                   seed=42) -> DataFrame:
    """One fold assignment per repeat; repeat r uses seed ``seed-r``.  Long
    form (row x repeat) so one rank job serves all repeats."""
    rep = df.sparkSession.range(repeats).select(F.col("id").cast("int").alias("repeat"))
    x = df.crossJoin(F.broadcast(rep))
    x = x.withColumn("_stratum", F.concat_ws(":", F.col("repeat").cast("string"),
                                             F.col(label_col).cast("string")))
    text = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}-"), F.col("repeat").cast("string"))
    x = x.withColumn("_key", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"))
    x = x.withColumn("_bkt", F.shiftright("_key", _BUCKET_SHIFT))
    bt = x.groupBy("_stratum", "_bkt").agg(F.count(F.lit(1)).alias("_bc"))
    wb = Window.partitionBy("_stratum").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select("_stratum", "_bkt", F.coalesce(F.sum("_bc").over(wb), F.lit(0)).alias("_bstart"))
    x = x.join(F.broadcast(bt), ["_stratum", "_bkt"])
    wi = Window.partitionBy("_stratum", "_bkt").orderBy("_key", id_col)
    rank = F.col("_bstart") + F.row_number().over(wi) - 1
    return x.withColumn("fold", (rank % k).cast("int")).drop("_stratum", "_key", "_bkt", "_bstart")
