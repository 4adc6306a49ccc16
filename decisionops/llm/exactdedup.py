"""Exact deduplication as a stateful stream (native operations only).

Texts are equal when they are identical after lower-casing A-Z only.  A file
stream reads the table's files (``availableNow``) and aggregates by the SHA-256
digest of the normalised text.  The state of that aggregation is the index: for
every digest the stable identifier that stays (largest doc_id), the content
locator of that row (file and row number in it) and the number of rows.  It is
kept on disk (RocksDB), snapshots and change logs go to ``state_dir`` on the
shared folder, and nothing in it expires; a lost executor loads its part again,
and a later run on the same ``state_dir`` reads new files only.

A digest with several rows is a hit.  The text at the locator (found by its
hash) is joined to the hit rows and compared byte by byte; rows whose bytes differ (a digest collision)
are grouped anew by their whole text.  Texts of rows without a hit are never
moved: the digests with hits are broadcast if there are at most
``BROADCAST_ROWS`` (counted first), beyond that rows are joined by digest.

Group sizes: copies are combined in the tasks before the state's shuffle.  In
the byte check the rows of a group are dealt out to cells of about
``CELL_ROWS``, each with its own copy of the kept text, so a text that a third
of all rows share is compared in many tasks.

Cases: a null text counts as empty; of repeated rows (equal doc_id and text) the
one with the last locator stays; a null doc_id is smaller than any other, so such
a row stays only in a group of nulls, with a null keep_id; texts of any length are
compared whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_table_path
from .common import stored, text_or_empty

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILES_PER_BATCH = 4096
BROADCAST_ROWS = 100_000        # digests with identifier and hash of the locator, some 60 bytes each
CELL_ROWS = 256

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",     # of an executor
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",        # many small stores take no space ahead
}


def normalised(text_col: str) -> Column:
    return F.translate(text_or_empty(text_col), UPPER, UPPER.lower())


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The settings hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(files: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """digest, text (normalised), loc (doc_id, file, row: identifier and content locator)."""
    loc = F.struct(F.col(id_col).alias("doc_id"), F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.row_index").alias("row"))
    return files.select(loc.alias("loc"), normalised(text_col).alias("text")).withColumn("digest", digest(F.col("text")))


def update_index(spark: SparkSession, source: str, state_dir: str, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Bring the state in ``state_dir`` up to date with the files of ``source``
    (a Parquet folder or file); files that it has seen are not read again."""
    schema = spark.read.parquet(source).select(id_col, text_col).schema
    source = source.rstrip("/")
    only = f"{source[:-1]}[{source[-1]}]"            # a pattern may name one file; a plain path must be a folder
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(only)
    state = (_rows(files, id_col, text_col, digest).groupBy("digest")
             .agg(F.max("loc").alias("keep"), F.count(F.lit(1)).alias("n")))
    with _settings(spark, _STATE_CONF):
        query = (state.writeStream.outputMode("update").format("noop")       # the state itself is what is read
                 .option("checkpointLocation", state_dir).trigger(availableNow=True).start())
        query.awaitTermination()


def index(spark: SparkSession, state_dir: str) -> DataFrame:
    """digest, keep (doc_id, file, row of the row that stays), n (rows)."""
    state = spark.read.format("statestore").load(state_dir)
    return state.select("key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def _cells(n: Column) -> Column:
    return F.ceil(n / F.lit(CELL_ROWS)).cast("int")


def decisions(spark: SparkSession, source: str, state_dir: str, id_col: str = "doc_id", text_col: str = "text",
              digest: Callable[[Column], Column] = sha256, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept of every row of ``source``, by the state in ``state_dir``."""
    hits = stored(index(spark, state_dir).where("n > 1").select(
        "digest", "n", F.col("keep.doc_id").alias("keep_id"), F.xxhash64("keep").alias("keep")), "exact_hits")
    n_hits = hits.count()
    rows = _rows(spark.read.parquet(source), id_col, text_col, digest).select(
        F.col("loc.doc_id").alias("doc_id"), F.xxhash64("loc").alias("at"), "digest", "text")
    if n_hits <= broadcast_rows:
        joined = rows.join(F.broadcast(hits), "digest", "left")
    else:
        # a text that makes up over a ten-thousandth of all rows is dealt out to cells; at most 10,000 can
        least = max(CELL_ROWS, index(spark, state_dir).agg(F.sum("n")).first()[0] // 10_000)
        hot = hits.where(F.col("n") > least).select("digest", _cells(F.col("n")).alias("cells"))
        salt = F.pmod("at", F.coalesce("cells", F.lit(1))).cast("int")
        dealt = F.when(F.col("n") > least, _cells(F.col("n"))).otherwise(F.lit(1))
        salted = rows.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt).drop("cells")
        copies = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), dealt - 1)))
        joined = salted.join(copies, ["digest", "salt"], "left")
    rows = stored(joined.select("doc_id", "at", "digest", "keep", "keep_id", "n",
                                F.when(F.col("n") > 1, F.col("text")).alias("text")), "exact_rows")

    out = ["doc_id", "digest", "keep_id", "n", "kept"]
    single = rows.where("n IS NULL").select("doc_id", "digest", F.col("doc_id").alias("keep_id"),
                                            F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept"))
    stays = rows.where("n IS NOT NULL AND at = keep")
    others = (rows.where("n IS NOT NULL AND NOT at = keep")
              .withColumn("salt", F.pmod("at", _cells(F.col("n"))).cast("int")))
    content = stays.select("digest", F.col("text").alias("kept_text"),
                           F.explode(F.sequence(F.lit(0), _cells(F.col("n")) - 1)).alias("salt"))
    checked = stored(others.join(content, ["digest", "salt"]).select(
        "doc_id", "at", "digest", "keep_id", "n", (F.col("text") == F.col("kept_text")).alias("same"),
        F.when(F.col("text") != F.col("kept_text"), F.col("text")).alias("text")), "exact_checked")

    grouped = (stays.withColumn("kept", F.lit(True)).select(out)
               .union(checked.where("same").withColumn("kept", F.lit(False)).select(out)))
    differ = checked.where("NOT same")
    if not differ.isEmpty():
        # digest collisions: the rest of each digest is grouped by its whole text
        less = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))
        grouped = (grouped.join(less, "digest", "left")
                   .withColumn("n", F.col("n") - F.coalesce("less", F.lit(0))).select(out))
        own = differ.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "at")).alias("keep"),
                                                   F.count(F.lit(1)).alias("n"))
        again = differ.select("doc_id", "at", "digest", "text").join(own, ["digest", "text"])
        grouped = grouped.union(again.select("doc_id", "digest", F.col("keep.doc_id").alias("keep_id"), "n",
                                             (F.col("at") == F.col("keep.at")).alias("kept")))
    return single.union(grouped).withColumnRenamed("n", "group_size")


def deduplicate(spark: SparkSession, source: str, state_dir: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``source``;
    by default with a new state on the shared folder."""
    state_dir = state_dir or shared_table_path(spark, f"llm/exact_state/{uuid.uuid4().hex}")
    update_index(spark, source, state_dir, id_col, text_col)
    out = decisions(spark, source, state_dir, id_col, text_col, **options)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL_EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""
