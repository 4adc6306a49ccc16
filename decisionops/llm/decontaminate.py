"""Benchmark decontamination by size-partitioned MinHash containment search
(native operations only).

Texts become sets of five-word shingles (lower case, words are runs of
letters and digits).  Benchmark items are partitioned by set size into powers
of two; every partition has its own MinHash sketch size, the bottom m hash
values of an item's shingles with m = floor((1 - t) * u) + ``MIN_HITS`` for the
upper size u of the partition.  An item of which a share t of the shingles occurs
in a document misses at most floor((1 - t) * n) of them, so at least that much
less than the sketch occurs in the document: the search misses nothing, however
long the document is, while a sketch of the document itself would lose short items
in long texts.  Documents too short for a partition are not searched in it.

Search: the documents' shingle hashes meet the sketch rows only, and (document,
item) pairs with enough sketch hits are candidates.  Verification: the shingles of
candidate documents are compared as words with all shingles of their candidate
items, and counted once each.

Sizes: the sketches are broadcast only when their row count, which is computed
first, is at most ``BROADCAST_ROWS``.  Beyond that hashes are shuffled, three
numbers each, never words; every hash is dealt out to ``SALTS`` cells, as a third
of all documents may share one.  Texts are only moved for candidate documents, and
only as single shingles.

Cases: null and empty texts have no shingles and match nothing; a text of
fewer than five words is one shingle (its whole word sequence); repeated rows
of a document are one document for the result; rows of one doc_id with
different texts are compared separately and the largest containment counts;
decontaminate drops only the rows with a contaminated text, of a repeated or null
doc_id too (in the pairs all null ids are one document);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHINGLE = 5
THRESHOLD = 0.8
MIN_HITS = 3              # sketch values that a contained item must hit, if it has that many
BROADCAST_ROWS = 1_000_000
SALTS = 16


def words(text_col: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(df: DataFrame, k: int) -> DataFrame:
    """One row per shingle position, with its hash ``h``; ``w`` is the word list."""
    last = F.greatest(F.size("w") - F.lit(k), F.lit(0))
    at = df.where(F.size("w") > 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return at.withColumn("h", F.xxhash64(*(F.get("w", F.col("i") + j) for j in range(k))))


def _shingle_text(k: int) -> Column:
    return F.concat_ws(" ", *(F.get("w", F.col("i") + j) for j in range(k)))


def _missing(n: Column, threshold: float) -> Column:
    """Most shingles of ``n`` that a contained item can miss."""
    return F.floor(F.lit(1 - threshold) * n + F.lit(1e-9))


def item_shingles(items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """item_id, h, shingle, n (distinct shingles of the item), in_sketch, hits (sketch rows
    that a document must have)."""
    sh = (_shingles(items.select("item_id", words("text").alias("w")), k)
          .select("item_id", "h", _shingle_text(k).alias("shingle")).distinct())
    n = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    sh = sh.withColumn("n", n)
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1           # largest size of the partition
    m = F.least(_missing(upper, threshold) + MIN_HITS, F.col("n"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("h"), "shingle"))
    return sh.withColumn("in_sketch", rank <= m).withColumn("hits", m - _missing(F.col("n"), threshold))


def _document_words(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("version"), words("text").alias("w"))


def candidates(docs: DataFrame, side: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD,
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, version (hash of the text), item_id of the pairs with enough sketch hits."""
    sketch = side.where("in_sketch").select("item_id", F.col("h").alias("ih"), "n", "hits")
    hashes = _shingles(_document_words(docs), k)
    long_enough = F.col("size") >= F.lit(threshold) * F.col("n")
    if sketch.count() <= broadcast_rows:
        hashes = hashes.select("doc_id", "version", F.size("w").alias("size"), "h")
        met = hashes.join(F.broadcast(sketch), (F.col("h") == F.col("ih")) & long_enough)
    else:
        salt = F.pmod(F.xxhash64("doc_id", "version"), F.lit(SALTS)).cast("int")
        hashes = hashes.select("doc_id", "version", F.size("w").alias("size"), "h", salt.alias("salt"))
        sketch = sketch.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = hashes.join(sketch, (F.col("h") == F.col("ih")) & (F.col("salt") == F.col("cell")) & long_enough)
    return (met.groupBy("doc_id", "version", "item_id", "hits").agg(F.size(F.collect_set("ih")).alias("met"))
            .where("met >= hits").select("doc_id", "version", "item_id"))


def _contaminated(docs: DataFrame, items: DataFrame, k: int, threshold: float,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, version (hash of the text), item_id, n (of the item), n_shared of the contained items."""
    side = stored(item_shingles(items.select("item_id", "text"), k, threshold), "leak_items")
    found = stored(candidates(docs, side, k, threshold, broadcast_rows), "leak_candidates")
    of_docs = found.select(F.col("doc_id").alias("_id"), F.col("version").alias("_of")).distinct()
    of_docs = F.broadcast(of_docs) if of_docs.count() <= broadcast_rows else of_docs.hint("shuffle_hash")
    rows = docs.select("doc_id", "text").join(
        of_docs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_of")), "left_semi")
    have = _shingles(_document_words(rows), k).select("doc_id", "version", _shingle_text(k).alias("shingle")).distinct()
    want = found.join(side.select("item_id", "shingle", "n"), found["item_id"].eqNullSafe(side["item_id"])).select(
        found["doc_id"].alias("_id"), found["version"].alias("_of"), found["item_id"].alias("item_id"),
        "n", F.col("shingle").alias("_shingle"))
    shared = have.join(want, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_of"))
                       & (F.col("shingle") == F.col("_shingle")))
    return (shared.groupBy("doc_id", "version", "item_id", "n").agg(F.count(F.lit(1)).alias("n_shared"))
            .where(F.col("n_shared") >= F.lit(threshold) * F.col("n") - F.lit(1e-9)))


def contaminated_pairs(docs: DataFrame, items: DataFrame, k: int = SHINGLE,
                       threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment (>= threshold)."""
    found = _contaminated(docs, items, k, threshold)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("n_shared").alias("n_shared"), F.max("n").alias("n_item"))
            .withColumn("containment", F.col("n_shared") / F.col("n_item")))


def decontaminate(docs: DataFrame, items: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text holds no benchmark item."""
    bad = (_contaminated(docs, items, k, threshold)
           .select(F.col("doc_id").alias("_bad_id"), F.col("version").alias("_bad_version")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_version"]), "left_anti")


SQL_DECONTAMINATE = """
WITH dw AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, text, array_to_string(w[i:i+4], ' ') AS s
       FROM (SELECT doc_id, text, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
its AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
size_of AS (SELECT item_id, count(*) AS n FROM its GROUP BY 1),
shared AS (SELECT doc_id, text, item_id, count(*) AS c FROM ds JOIN its USING (s) GROUP BY 1, 2, 3)
SELECT doc_id, item_id, max(c) AS n_shared, max(n) AS n_item, max(c) / max(n) AS containment
FROM shared JOIN size_of USING (item_id) WHERE c >= 0.8 * n - 1e-9 GROUP BY doc_id, item_id"""
