"""SimHash near-duplicate groups with deletion-variant signatures.

A fingerprint is 64 majority bits over the XXH64 hashes (seed 42) of a text's
word shingles.  Two fingerprints that differ in at most k bits are found by
cutting them into s = floor(k / 2) + 1 segments: one of the segments differs
in at most one bit (k = 2: two segments of 32 bits, where an exact-segment
index would need three).  Every segment is indexed under its one-wildcard
variants (one bit position deleted), so segments within one bit share an
entry, which is an equality key; matches are verified by the bit distance.

Index entries are grouped by key.  All variants that delete a bit of the same
byte share the rest of their segment, so a fingerprint is shuffled once per
byte, and its variants are made and grouped where that part has gone.  An entry
with two distinct fingerprints is verified from its minimum and maximum.  The
fingerprints of an entry with three or more (crowded: a group of near copies
that share a segment) are linked by the exact, linear form of the same idea
for the whole fingerprint: two values are within 2j bits when they share a
value within j bits of both, so for k = 2 each crowded fingerprint is keyed by
itself and its 64 one-bit variants; at most 65 fingerprints can share such a
key, all of them are within two bits of each other, and each is linked to the
smallest.  No group of copies is expanded into pairs, and no pair is lost.

Copies of a text fall on one fingerprint before anything is indexed.

Cases: a null, empty or blank text has fingerprint zero, linked like any
other; fewer words than a shingle: the whole sequence is the one shingle;
repeated rows keep one row each; a null doc_id gets the component of its
fingerprint (nulls are not candidates for the smallest id; a component of
null ids only has a null component_id); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, stored
from .components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BLOCK_BYTES = 1 << 22       # texts are shingled in blocks of this size


def _word_blocks(raw: bytes):
    """Lists of words of a text, a block at a time (words are never cut)."""
    if len(raw) <= BLOCK_BYTES:
        yield raw.split()
        return
    start = 0
    while start < len(raw):
        end = start + BLOCK_BYTES
        while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[start:end].split()
        start = end


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits (a bit is set when over half the hashes have it)."""
    ones, total, carry = np.zeros(64, np.int64), 0, []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for block in _word_blocks((text or "").encode().lower()):
        words = carry + block
        grams = zip(*(words[i:] for i in range(shingle)))
        h = np.fromiter((digest(join(g), SEED) for g in grams), np.uint64)
        if len(h):
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(h)
        carry = words[len(words) - shingle + 1:] if len(words) >= shingle else words
    if not total and carry:
        h = np.array([digest(join(carry), SEED)], np.uint64)
        ones, total = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint_column(text_col: str, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
        give_back()

    return simhash(F.col(text_col))


def _field(fp: str, low: int, n: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), low).bitwiseAND(F.lit((1 << n) - 1))


def shared_parts(fp: str) -> Column:
    """For every segment of 32 bits and every byte of it: the segment's other
    24 bits, tagged with segment and byte.  A segment that differs in one bit
    is equal in three bytes, so all one-wildcard variants that delete a bit of
    the fourth have this part in common: they are dealt out by it, once."""
    keys = []
    for seg in range(2):
        whole = _field(fp, 32 * seg, 32)
        for byte in range(4):
            rest = whole.bitwiseAND(F.lit(0xFFFFFFFF ^ (0xFF << 8 * byte)))
            keys.append(F.struct(F.lit((seg << 2 | byte) << 32).bitwiseOR(rest).alias("part"),
                                 _field(fp, 32 * seg + 8 * byte, 8).cast("int").alias("byte")))
    return F.array(*keys)


def byte_variants(byte: str) -> Column:
    """The one-wildcard variants of a byte: position and the other seven bits."""
    return F.array(*[F.lit(p << 8).bitwiseOR(F.col(byte).bitwiseAND(F.lit(0xFF ^ (1 << p)))) for p in range(8)])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps`` (fp: distinct longs) -> edges (a, b) whose components are those
    of the relation "differ in at most ``max_bits`` bits"."""
    if max_bits != 2:
        raise ValueError("the index is built for a distance of two bits")
    parts = fps.select("fp", F.explode(shared_parts("fp")).alias("k")).select("fp", "k.part", "k.byte")
    # grouping by (part, variant) needs no shuffle besides the one by part
    index = parts.repartition("part").select("fp", "part", F.explode(byte_variants("byte")).alias("variant"))
    entries = stored(index.groupBy("part", "variant").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash_entries")
    pairs = (entries.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b").distinct())
    # every fingerprint of a part with a crowded entry takes the exact way for crowds
    crowded = parts.join(entries.where("n > 2").select("part").distinct(), "part", "left_semi").select("fp").distinct()
    ball = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << p) - (1 << 64 if p == 63 else 0)))
                                  for p in range(64)))
    hubs = (crowded.select("fp", F.explode(ball).alias("near"))
            .groupBy("near").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))      # 65 at most
    stars = (hubs.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
             .where(F.col("a") != F.col("b")).distinct())
    return pairs.union(stars)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows as (doc_id, version, fp), and (fp, first_id, root): the component's
    smallest fingerprint as its root."""
    base = stored(small_batches(docs).select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("version"),
                              fingerprint_column(text_col, shingle).alias("fp")), "simhash_docs")
    first = stored(base.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_distinct")
    roots = connected_components(links(first.select("fp"), max_bits), "simhash_edges")
    linked = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return base, linked.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, version (hash of the text), fp (long), fingerprint (16 hex
    digits), component_id (smallest doc_id that links reach, itself included)."""
    base, linked = _grouped(docs, id_col, text_col, shingle, max_bits)
    of_root = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = linked.join(of_root, "root").select("fp", "component_id")
    return (base.join(of_fp, "fp")
            .select("doc_id", "version", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


BROADCAST_KEYS = 500_000      # rows that go, by (doc_id, version): 16 bytes each before hashing


def _by_size(keys: DataFrame) -> DataFrame:
    """The key side of a join: broadcast up to ``BROADCAST_KEYS``; above that rows are
    hashed by the key once and looked up, not sorted (they hold whole texts)."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("shuffle_hash")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs`` (all columns), one of each group: the smallest doc_id and
    of its texts in the group the smallest version (of repeated rows, one); rows
    without a doc_id stay.  A doc_id whose texts are in several groups can be
    kept once for each.  Which rows go is decided on (doc_id, version) alone."""
    base, linked = _grouped(docs.select("doc_id", "text"), "doc_id", "text", shingle, max_bits)
    least = F.min(F.struct("doc_id", "version", "n")).alias("k")
    copies = base.where("doc_id IS NOT NULL").groupBy("fp", "doc_id", "version").agg(F.count(F.lit(1)).alias("n"))
    copies = stored(copies, "simhash_copies")
    of_fp = copies.groupBy("fp").agg(least).select("fp", "k.*")
    found = stored(of_fp.join(linked.select("fp", "root"), "fp").groupBy("root").agg(least).select("k.*"), "simhash_kept")
    go = stored(copies.join(found, ["doc_id", "version"], "left_anti").select("doc_id", "version"), "simhash_dropped")

    def on(keys: DataFrame) -> Column:
        return (F.col("doc_id") == keys["_id"]) & (F.xxhash64("text") == keys["_of"])

    def named(keys: DataFrame) -> DataFrame:
        return _by_size(keys.select(F.col("doc_id").alias("_id"), F.col("version").alias("_of")))

    kept, again = docs.join(go := named(go), on(go), "left_anti"), found.where("n > 1")
    if not again.isEmpty():
        again = named(again)
        once = kept.join(again, on(again), "left_semi").withColumn("_of", F.xxhash64("text"))
        once = once.dropDuplicates(["doc_id", "_of"]).select(docs.columns)
        kept = kept.join(again, on(again), "left_anti").union(once)
    return kept.select(docs.columns)
