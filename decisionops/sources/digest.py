"""Digest of file bytes, computed in parallel.

A file is read as lines (ranges of bytes between line feeds, whatever the file
holds), in splits as the cluster cuts them.  Every line has a SHA-256; lines are
numbered inside their file; the digests of ``LINES`` consecutive lines are hashed
together, and those in turn, in order, with the file's size.  The result depends on
the bytes alone, not on splits, partitions or the order of tasks, and no row ever
holds a file: what is shuffled is 32 bytes a line.

``tree_digest`` computes the same from a byte string.  Cases: an empty file has no
lines, only its size; bytes that are not text are hashed as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINES = 4096


def tree_digest(content: bytes, lines: int = LINES) -> str:
    parts = content.split(b"\n")
    if not parts[-1]:
        parts.pop()                                # a final line feed ends the last line
    leaves = [hashlib.sha256(p).digest() for p in parts]
    nodes = [hashlib.sha256(b"".join(leaves[i:i + lines])).digest() for i in range(0, len(leaves), lines)]
    return hashlib.sha256(str(len(content)).encode() + b":" + b"".join(nodes)).hexdigest()


def file_digests(spark: SparkSession, path: str, lines: int = LINES) -> DataFrame:
    """file (name), bytes, lines, digest of every file under ``path``."""
    read = spark.read.option("lineSep", "\n").text(path)
    rows = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                       F.col("_metadata.file_block_start").alias("block"), F.sha2(F.col("value").cast("binary"), 256).alias("h"),
                       F.monotonically_increasing_id().alias("seq"))
    # blocks: one row a split; a line's number is its place in the split after the lines of earlier splits
    blocks = rows.groupBy("file", "block").agg(F.min("seq").alias("start"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "start", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = rows.join(blocks, ["file", "block"]).withColumn("line", F.col("before") + F.col("seq") - F.col("start"))
    def in_order(key: str, digest: str):
        pairs = F.sort_array(F.collect_list(F.struct(F.col(key), F.col(digest).alias("d"))))
        return F.unhex(F.concat_ws("", F.transform(pairs, lambda p: p["d"])))

    nodes = (numbered.withColumn("node", F.floor(F.col("line") / F.lit(lines)))
             .groupBy("file", "bytes", "node").agg(F.count(F.lit(1)).alias("n"), F.sha2(in_order("line", "h"), 256).alias("d")))
    files = nodes.groupBy("file", "bytes").agg(F.sum("n").alias("lines"), in_order("node", "d").alias("all"))
    name = F.element_at(F.split("file", "/"), -1)
    head = F.concat(F.col("bytes").cast("string"), F.lit(":")).cast("binary")
    return files.select(name.alias("file"), "bytes", "lines", F.sha2(F.concat(head, F.col("all")), 256).alias("digest"))
