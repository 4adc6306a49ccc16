"""Stable assignment does not depend on the number of partitions."""

from pyspark.sql import functions as F

from decisionops.operators import split as sp


def test_split_and_folds_partition_independent(spark):
    base = spark.range(5000).select(F.col("id").alias("application_id"),
                                    (F.col("id") % 3 == 0).cast("int").alias("label"))
    outs = []
    for n in (1, 8):
        df = base.repartition(n)
        s = sp.stratified_split(df, "application_id", "label", 0.2, 2026)
        f = sp.stratified_folds(df, "application_id", "label", 5, 42)
        outs.append((sorted(tuple(r) for r in s.select("application_id", "split").collect()),
                     sorted(tuple(r) for r in f.select("application_id", "fold").collect())))
    assert outs[0] == outs[1]


def test_split_sizes_are_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("application_id"),
                                  (F.col("id") < 300).cast("int").alias("label"))
    s = sp.stratified_split(df, "application_id", "label", 0.2, 7)
    got = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert got == {(1, "test"): 60, (1, "dev"): 240, (0, "test"): 140, (0, "dev"): 560}
    f = sp.stratified_folds(df, "application_id", "label", 5, 7)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2
