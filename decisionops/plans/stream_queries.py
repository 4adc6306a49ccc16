"""Streaming queries over a file stream of applications; their rows equal those
of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import validate as va
from ..session import materialized_path
from ..sources import io
from ..streaming import applications as sa
from ..streaming.decisions import run_available_now
from .analysis_frame import ROUTE_MANUAL, analysis_frame_sql
from .data_queries import _sql_clean_ctes, _validate_sql
from .fixtures import SQL_APPLICATIONS_V1, SQL_APPLICATIONS_V2_RAW, V1_PREDICTORS, applications_v1_dated, applications_v2_raw


def stream_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    applications_v1_dated(spark, sf_dir)               # materialised input files
    src = materialized_path(spark, "applications_v1", (sf_dir,))
    base = io.run_path(spark, "streams/route_counts")
    return run_available_now(spark, src, base + "/out", base + "/checkpoint")


def sql_stream_route_counts() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT simulation_day AS day, baseline_route AS route, count(*) AS applications
FROM analysis GROUP BY 1, 2"""


def stream_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    applications_v1_dated(spark, sf_dir)
    base = io.run_path(spark, "streams/daily_trend")
    return sa.daily_trend(spark, materialized_path(spark, "applications_v1", (sf_dir,)), base + "/out", base + "/checkpoint")


def sql_stream_daily_trend() -> str:
    return "WITH " + analysis_frame_sql() + f"""
SELECT simulation_day AS date, count(*) AS applications,
  round(count_if(historical_approved) / count(*), 6) AS historical_approval_rate,
  round(count_if(baseline_route = '{ROUTE_MANUAL}') / count(*), 6) AS manual_review_rate
FROM analysis WHERE simulation_day IS NOT NULL GROUP BY 1"""


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per outcome of the validation of a file stream: none broken, or which rules."""
    applications_v1_dated(spark, sf_dir)
    base = io.run_path(spark, "streams/quarantine")
    good, bad = sa.quarantine(spark, materialized_path(spark, "applications_v1", (sf_dir,)), base + "/out",
                              base + "/checkpoint", va.V1_RULES, lambda df: df.select("application_id", *V1_PREDICTORS))
    rows = good.select(F.lit("").alias("violations"), F.lit(True).alias("valid")).unionByName(
        bad.select("violations", F.lit(False).alias("valid")))
    return rows.groupBy("valid", "violations").agg(F.count(F.lit(1)).alias("rows"))


def sql_stream_quarantine() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
v AS ({_validate_sql(va.V1_RULES, "application_id", "applications_v1")})
SELECT valid, violations, count(*) AS rows FROM v GROUP BY 1, 2"""


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned v2 rows from a file stream: coerced, clipped, the first of equal rows."""
    applications_v2_raw(spark, sf_dir)
    base = io.run_path(spark, "streams/clean")
    out = sa.first_of_equal(spark, materialized_path(spark, "applications_v2_raw", (sf_dir,)), base + "/out",
                            base + "/checkpoint", cl.DEDUP_SUBSET, "loan_id",
                            lambda df: cl.clip_assets(cl.normalize(df)))
    return out.withColumn("target", cl.target())


def sql_stream_clean() -> str:
    cols = ", ".join(dict.fromkeys([*cl.DEDUP_SUBSET, "loan_id", "target"]))
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f"\nSELECT {cols} FROM clean"


QUERIES = {
    "stream_route_counts": (stream_route_counts, sql_stream_route_counts),
    "stream_daily_trend": (stream_daily_trend, sql_stream_daily_trend),
    "stream_quarantine": (stream_quarantine, sql_stream_quarantine),
    "stream_clean": (stream_clean, sql_stream_clean),
}
