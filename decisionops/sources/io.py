"""Sinks and sources: JSON reports, model artifacts, staged publication,
run metadata.  All paths live under the shared folder the cluster names in
``spark.checkpoint.dir`` (never a machine-local temp dir)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_table_path


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh location for one run's output (no clean-up of old runs)."""
    return shared_table_path(spark, f"{name}/{uuid.uuid4().hex}")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def staged_publish(df: DataFrame, staging: str, published: str, checks) -> DataFrame:
    """Write ``df`` to ``staging``; run ``checks(staged_df)`` (rows of check,
    passed, detail) on what was written; publish it only when every check
    passed.  Every publication is a new version folder, and one small pointer
    record, written after it, names the version that ``read_published`` reads:
    readers never see a half-written table, and a bad load leaves the good one."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    res = checks(staged)
    failed = res.where(~F.col("passed")).count()
    if failed == 0:
        version = f"{published}/versions/{uuid.uuid4().hex}"
        staged.write.parquet(version)
        spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at")) \
            .coalesce(1).write.mode("append").parquet(f"{published}/pointer")
    status = "published" if failed == 0 else "rejected"
    return res.select("*", F.lit(status).alias("status"))


def read_published(spark: SparkSession, published: str) -> DataFrame:
    """The version that was published last."""
    last = spark.read.parquet(f"{published}/pointer").orderBy(F.col("at").desc()).first()
    return spark.read.parquet(last["version"])


def append_run(record: DataFrame, log: str) -> None:
    """Append a run's record to the one log; earlier runs stay."""
    record.coalesce(1).write.mode("append").parquet(log)


def read_runs(spark: SparkSession, log: str, as_of=None) -> DataFrame:
    """All runs of the log, or those up to a point in time."""
    runs = spark.read.parquet(log)
    return runs if as_of is None else runs.where(F.col("created_at") <= F.lit(as_of))
