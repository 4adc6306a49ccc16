"""Streaming routing: score and route applications as files arrive, count
decisions per event-time day.

Scoring, routing and the hash enrichment are row-local, so the same column
expressions serve batch and stream.  Re-delivered applications count once.
The sink is ``foreachBatch`` writing the
complete result table to the shared folder (exactly-once via the query
checkpoint)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_uniforms
from ..operators.features import add_v1_features
from ..operators.scorecard import DEFAULT_SCORECARD, probability
from ..plans.analysis_frame import DEFAULT_APPROVE, DEFAULT_REJECT, route


def decisions(apps: DataFrame, approve: float = DEFAULT_APPROVE, reject: float = DEFAULT_REJECT,
              keep: tuple = ()) -> DataFrame:
    """Row-local: score, route and event time (the day of the application, at
    a drawn time of day); batch or streaming input.  ``keep``: further columns."""
    k = F.col("application_id")
    u = hash_uniforms(k, "ops1", 3)
    day = F.col("applied_on")
    hour = (F.lit(8) + F.floor(u[0] * 11)).cast("int")
    minute = F.floor(u[1] * 60).cast("int")
    # event instant fixed in UTC (not the session time zone); the day label
    # comes from the date itself, so results never depend on the session zone
    ts = F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), hour, minute, F.lit(0), F.lit("UTC"))
    x = add_v1_features(apps).withColumn("p", probability(DEFAULT_SCORECARD))
    return x.select("application_id", route("p", approve, reject).alias("route"), ts.alias("created_ts"),
                    F.date_format(day, "yyyy-MM-dd").alias("day"), *keep)


def daily_route_counts(decided: DataFrame, watermark: str | None = None) -> DataFrame:
    """Decisions per day and route, each application once.  Without a watermark
    every id stays in the state, so the result does not depend on how the
    input is cut into micro-batches.  A watermark bounds the state; it must be
    wider than the disorder of the input (``run_available_now`` fails if a row
    came too late)."""
    if watermark is None:
        once = decided.dropDuplicates(["application_id"])
    else:
        once = decided.withWatermark("created_ts", watermark).dropDuplicatesWithinWatermark(["application_id"])
    return once.groupBy("day", "route").count()


def run_available_now(spark: SparkSession, source_path: str, out_path: str, checkpoint: str,
                      max_files: int = 64, watermark: str | None = None) -> DataFrame:
    """Process every file present now (``availableNow``), then stop; return
    the result table."""
    schema = spark.read.parquet(source_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source_path)
    agg = daily_route_counts(decisions(stream), watermark)

    def sink(batch: DataFrame, _epoch: int) -> None:
        (batch.groupBy("day", "route").agg(F.sum("count").cast("long").alias("applications"))
         .write.mode("overwrite").parquet(out_path))

    q = (agg.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
               for op in json.loads(p.json)["stateOperators"])
    if late:
        raise RuntimeError(f"{late} rows came later than the watermark of {watermark} allows")
    return spark.read.parquet(out_path)
