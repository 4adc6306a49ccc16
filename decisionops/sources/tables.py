"""Parquet table source for the given star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filter push-down reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass over the
    data); an empty field reads as NULL, a malformed value as NULL
    (PERMISSIVE mode), never a failed job."""
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .option("nullValue", "").csv(path))
