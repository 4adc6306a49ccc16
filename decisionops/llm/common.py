"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_table_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet under the folder that the
    cluster shares (``spark.checkpoint.dir``) and read it back.  A lost
    executor then costs a re-read, never a recomputation, and values that
    depend on the run (row keys) are fixed by the write."""
    spark = df.sparkSession
    path = shared_table_path(spark, f"llm/{name}/{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """Rows go to Python workers in batches of at most ``BATCH_ROWS`` and about
    ``BATCH_BYTES``: a row holds a whole text, and a worker keeps the memory of
    its largest batch.  Both are settings of the session; fewer
    rows and a size that someone has set stay."""
    conf, rows = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(rows))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    if (size := "spark.sql.execution.arrow.maxBytesPerBatch") not in conf.getAll:
        conf.set(size, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return what a task has freed to the system.  Python workers stay alive between stages,
    and allocators keep freed memory, so idle workers would add up beside a full heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:                          # glibc
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def crc_mod(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(k))


def cells_for(n_rows: int, rows_per_cell: int = 200_000, least: int = 32) -> int:
    """Number of hash cells that keeps a cell near ``rows_per_cell`` rows."""
    return max(least, -(-n_rows // rows_per_cell))


HASH_BITS, LEVEL_BITS = 60, 12


def sample_hash(*cols: str, salt: str) -> Column:
    """A hash of ``HASH_BITS`` bits; equal rows have equal ones."""
    return F.xxhash64(*cols, F.lit(salt)).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def sample_bounds(rows: DataFrame, group: str, u: str, most: int) -> dict:
    """group -> upper bound (exclusive) of ``u`` (``sample_hash``) under which it has at most
    ``most`` rows, equal hashes counted once, and nearly as many if there are.

    Rows are counted per group and hash prefix (4096 a group); the prefix that would overflow
    is split by its next bits, so however many rows share an id or a text, no more than
    ``most`` rows a group are ever taken."""
    taken: dict = {}             # rows so far
    bound: dict = {}
    open_at: dict = {}           # prefix that is split next
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        here = rows.withColumn("_prefix", F.shiftright(u, shift))
        if level > 1:
            if not open_at:
                break
            inside = rows.sparkSession.createDataFrame(
                [(g, p) for g, p in open_at.items()], f"_g {rows.schema[group].dataType.simpleString()}, _p long")
            here = here.join(F.broadcast(inside), F.col(group).eqNullSafe(F.col("_g"))
                             & (F.shiftright("_prefix", LEVEL_BITS) == F.col("_p")), "left_semi")
        per: dict = {}
        for r in here.groupBy(group, "_prefix").count().collect():        # groups x 4096 counts
            per.setdefault(r[group], {})[r["_prefix"]] = r["count"]
        open_at = {}
        for g, counts in per.items():
            for prefix in sorted(counts):
                n = counts[prefix] if shift else 1                      # at the last level all hashes are equal
                if taken.get(g, 0) + n > most:
                    if shift and taken.get(g, 0) < most:
                        open_at[g] = prefix
                    break
                taken[g] = taken.get(g, 0) + n
                bound[g] = (prefix + 1) << shift
    return bound
