"""Event-time and row-level forms of the batch jobs on a stream of application files.

* ``daily_trend``: the trend report as event-time windows of a day under a watermark.
* ``quarantine``: row validation with two sinks, rows that pass and rows that don't
  (with the rules they break).
* ``first_of_equal``: de-duplication on features and label; the state keeps the
  smallest id of every distinct row and can be bounded by a watermark.

Every run processes the files that are there and stops (``availableNow``); a later run
on the same checkpoint goes on with new files.  Sinks write one folder per micro-batch
under its number and replace it when the batch is repeated after a failure, so results
are exactly-once; updated groups are read back with their last version.  Results do not
depend on how files are cut into micro-batches.  Rows later than the watermark end the
run with an error instead of being lost silently.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import rule_ok, with_defaults
from ..plans.analysis_frame import ROUTE_MANUAL
from .decisions import decisions

WATERMARK = "3650 days"           # of files in any order; bounds the state of a log in time order when set lower


def source(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str) -> None:
    """Process what is there; fail if rows came later than the watermark allows."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
               for op in json.loads(p.json)["stateOperators"])
    if late:
        raise RuntimeError(f"{late} rows came later than the watermark allows")


def _into(path: str) -> Callable[[DataFrame, int], None]:
    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return sink


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last version of every group that the batches updated."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*keys, "_last.*")


def daily_trend(spark: SparkSession, path: str, out: str, checkpoint: str, max_files: int = 64,
                watermark: str = WATERMARK) -> DataFrame:
    """date, applications, historical_approval_rate, manual_review_rate per event-time day."""
    approved = F.coalesce(F.trim("loan_status") == "Y", F.lit(False)).alias("approved")
    x = decisions(source(spark, path, max_files), keep=(approved,))
    w = x.withWatermark("created_ts", watermark).groupBy(F.window("created_ts", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("applications"), F.count_if("approved").alias("approved"),
        F.count_if(F.col("route") == ROUTE_MANUAL).alias("manual"))
    run(w.select(F.date_format("w.start", "yyyy-MM-dd").alias("date"), "applications", "approved", "manual"),
        checkpoint, _into(out), "update")
    n = F.col("applications")
    return latest(spark, out, ["date"]).select(
        "date", "applications", F.round(F.col("approved") / n, 6).alias("historical_approval_rate"),
        F.round(F.col("manual") / n, 6).alias("manual_review_rate"))


def quarantine(spark: SparkSession, path: str, out: str, checkpoint: str, rules: dict,
               prepare: Callable[[DataFrame], DataFrame] = lambda df: df, max_files: int = 64) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``violations``) of all batches so far."""
    rows = with_defaults(prepare(source(spark, path, max_files)), rules)
    broken = F.array_compact(F.array(*[F.when(~rule_ok(n, s), F.lit(n)) for n, s in rules.items()]))
    checked = rows.withColumn("violations", F.array_join(broken, ","))

    def sink(batch: DataFrame, number: int) -> None:
        batch.persist()                            # both sinks read the checked rows
        try:
            batch.where("violations = ''").drop("violations").write.mode("overwrite").parquet(f"{out}/valid/batch={number}")
            batch.where("violations <> ''").write.mode("overwrite").parquet(f"{out}/quarantine/batch={number}")
        finally:
            batch.unpersist()

    run(checked, checkpoint, sink, "append")
    return tuple(spark.read.parquet(f"{out}/{part}").drop("batch") for part in ("valid", "quarantine"))


def first_of_equal(spark: SparkSession, path: str, out: str, checkpoint: str, subset: list[str], id_col: str,
                   prepare: Callable[[DataFrame], DataFrame] = lambda df: df, max_files: int = 64,
                   watermark: tuple[str, str] | None = None) -> DataFrame:
    """The rows of ``subset`` columns, each distinct one once, with its smallest id.  ``watermark``
    (event-time column, delay): the state forgets rows of days that have closed, and equal rows of
    different days are then different rows."""
    rows = prepare(source(spark, path, max_files))
    keys = list(subset)
    if watermark:
        rows = rows.withWatermark(*watermark).withColumn("_day", F.window(watermark[0], "1 day"))
        keys.append("_day")
    g = rows.groupBy(*keys).agg(F.min(id_col).alias(id_col))
    run(g, checkpoint, _into(out), "update")
    return latest(spark, out, keys)
