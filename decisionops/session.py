"""SparkSession construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the package relies on.  AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splitting handles hot
# keys (one key may hold a third of the rows).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "decisionops", driver_memory: str | None = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        # only effective when this call starts the JVM (local runs, tests)
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  When it is unset, a scratch folder is created
    on a local master (tests); on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="decisionops-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A location for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


_MATERIALIZED: dict = {}
_PATHS: dict = {}


def materialize(df, name: str, key=(), spark=None):
    """Cut the lineage of a derived table that many plans reuse: write it once
    per session and key as a parquet table under the shared checkpoint
    folder and read it back.  Later plans start from the written table -- a
    small logical plan, column pruning and filter push-down into the scan,
    and no recomputation after an executor loss.  Never ``localCheckpoint``.
    ``df`` may be a zero-argument builder (then ``spark`` is required)."""
    import uuid
    spark = spark if spark is not None else df.sparkSession
    k = (spark.sparkContext.applicationId, name, key)
    out = _MATERIALIZED.get(k)
    if out is None:
        if callable(df):           # a builder: only construct the plan on a miss
            df = df()
        path = shared_table_path(spark, f"materialized/{name}/{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        _MATERIALIZED[k] = out
        _PATHS[k] = path
    return out


def materialized_path(spark, name: str, key=()):
    return _PATHS.get((spark.sparkContext.applicationId, name, key))
