"""Artifacts of the model builds, for readers outside the session.

A build publishes what it scored (out-of-fold and holdout scores, coefficients,
variants) as Parquet tables of fixed names under the shared folder; a later build
replaces them.  Oracle SQL reads these scores and computes everything that follows
from them (metrics, selection, blends, explanations) independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_table_path


def artifact_path(spark: SparkSession, name: str) -> str:
    return shared_table_path(spark, f"artifacts/{name}")


def publish(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").parquet(artifact_path(df.sparkSession, name))


def artifact_sql(name: str) -> str | None:
    """A table expression for DuckDB, or None where no session tells the folder or
    DuckDB cannot open it."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None
    path = artifact_path(spark, name)
    path = path.removeprefix("file://").removeprefix("file:")
    return None if "://" in path else f"read_parquet('{path}/*.parquet')"


def over_artifacts(sql, *names: str):
    """Oracle factory: ``sql`` gets a table expression for each artifact; None without them."""
    def factory() -> str | None:
        tables = [artifact_sql(n) for n in names]
        return None if None in tables else sql(*tables)
    return factory
