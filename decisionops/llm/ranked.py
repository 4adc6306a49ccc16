"""Ranked lexical search by presence-mask grouping.

Every query item asks for its k best documents by an integer BM25 form.  Terms are
runs of ASCII letters, ASCII digits and any non-ASCII characters, A-Z lower-cased.

* One pass over the documents keeps, for the terms that any item has, a posting
  list a document (term numbers, occurrences) besides its length, written once.
  Corpus figures (N, L, df) are aggregates of that table, over all documents.
* Documents are scored in blocks of ``BLOCK_DOCS`` inside a task.  A term of a
  block is a bitmap over its documents.  For an item the bitmaps of its terms are
  turned into one presence mask a document, and documents are grouped by mask.
  A mask's maximum is the sum of its terms' largest impacts in the block.
* Masks are evaluated by descending maximum, exactly, until the next maximum is
  below the item's k-th best score so far: nothing after it can enter the list
  (an equal maximum is still evaluated, ties go to the smaller id).  The best
  lists go on from block to block in a task.
* Lists of tasks are merged in two steps (per item and salt, then per item), so
  no group grows with the number of documents beyond its k rows a task.

Items are handled in chunks of at most ``CHUNK_TERMS`` query terms, which bounds
what goes out to the tasks; every chunk is one more pass over the documents.

Cases: null and empty texts have no terms, count nowhere and are never returned;
an item without terms, or without a matching document, has no rows; repeated item
rows count once, different texts of one item_id are one query of all their terms;
a null item_id is an item; repeated document rows are documents of their own, a
null doc_id comes last among equal scores; texts of any length are read whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# the same classes in UTF-8 bytes: every byte of a non-ASCII character is 0x80 or above
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TOP = 10
BLOCK_DOCS = 8192
CHUNK_TERMS = 200_000
SALTS = 64
_NO_ID = np.iinfo(np.int64).max


def terms(raw: bytes) -> list[bytes]:
    return _TERM_BYTES.findall(raw.lower())           # bytes.lower changes A-Z only


# ---- items --------------------------------------------------------------------

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, term, n (occurrences) of the distinct texts of each item."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.regexp_extract_all(F.translate(text_col, upper, upper.lower()), F.lit(TERM), F.lit(0))
    return (items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
            .select("item_id", F.explode(found.alias("f")).alias("term"))
            .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("n")))


def chunks(by_item: DataFrame, chunk_terms: int = CHUNK_TERMS) -> int:
    """Number of chunks of items so that one has about ``chunk_terms`` (item, term) rows at most."""
    n = by_item.count()
    return 1 if n <= chunk_terms else math.ceil(2 * n / chunk_terms)


# ---- postings -----------------------------------------------------------------

def postings(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), t, tf (numbers of the vocabulary's terms in the document
    and their occurrences) of the documents with at least one term."""
    number = {t.encode(): k for k, t in enumerate(vocabulary)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ns, ts, tfs = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                if found:
                    own = [(number[w], c) for w, c in Counter(found).items() if w in number]
                    ids.append(i)
                    ns.append(len(found))
                    ts.append([k for k, _ in own])
                    tfs.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ts, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "t", "tf"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, t array<int>, tf array<int>")


def weights(posted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each vocabulary term, from all documents."""
    n_docs, n_all = posted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = posted.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    held = dict.fromkeys(range(n_terms), 0) | {r.t: r.df for r in df}                  # at most CHUNK_TERMS rows
    return n_docs, n_all, np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                                    for t in range(n_terms)], np.int64)


# ---- blocks -------------------------------------------------------------------

class Block:
    """Posting lists and bitmaps of the documents of a block."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray,
                 n_docs: int, n_all: int, weight: np.ndarray):
        self.ids, self.size = ids, len(ids)
        m = 100 - 75 + 75 * n * n_docs // n_all
        order = np.argsort(term, kind="stable")                # documents stay ascending inside a term
        self.doc, tf, by = doc[order], tf[order], term[order]
        self.impact = weight[by] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc]))
        self.terms, self.first = np.unique(by, return_index=True)
        self.last = np.append(self.first[1:], len(by))
        self.most = np.maximum.reduceat(self.impact, self.first) if len(by) else self.impact
        bits = np.zeros((len(self.terms), self.size), bool)
        bits[np.repeat(np.arange(len(self.terms)), self.last - self.first), self.doc] = True
        self.bitmaps = np.packbits(bits, axis=1)

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold any of the terms (by row), and their masks as bit rows."""
        any_term = np.bitwise_or.reduce(self.bitmaps[rows], axis=0)
        docs = np.flatnonzero(np.unpackbits(any_term, count=self.size))
        held = np.unpackbits(self.bitmaps[rows], axis=1, count=self.size)[:, docs]
        packed = np.packbits(held, axis=0)                     # a byte has eight terms of a document
        pad = np.zeros((-len(packed) % 8, len(docs)), np.uint8)
        words = np.ascontiguousarray(np.vstack([packed, pad]).T).view(np.uint64)
        return docs, words

    def search(self, wanted: np.ndarray, times: np.ndarray, best: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """The ``top`` best (score, -id) of ``best`` and the block's documents, by ``times`` occurrences
        of each ``wanted`` term (ascending numbers)."""
        place = np.minimum(np.searchsorted(self.terms, wanted), max(len(self.terms) - 1, 0))
        ok = self.terms[place] == wanted if len(self.terms) else np.zeros(len(wanted), bool)
        rows, times = place[ok], times[ok]
        if not len(rows):
            return best
        least = best[-1][0] if len(best) == top else 1         # scores above 0 only
        most = self.most[rows] * times
        if int(most.sum()) < least:
            return best
        docs, words = self.masks(rows)
        group = np.zeros(len(docs), np.int64)
        for column in words.T:                                 # equal masks, 64 terms at a time
            _, code = np.unique(column, return_inverse=True)
            _, group = np.unique(group * (int(code.max()) + 1) + code, return_inverse=True)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(group[order]) > 0))
        ends = np.append(starts[1:], len(order))
        bits = np.unpackbits(words[order[starts]].view(np.uint8), axis=1, count=len(rows)).astype(np.int64)
        ceiling = bits @ most
        by_ceiling = np.argsort(-ceiling, kind="stable")
        at, step = 0, 1
        while at < len(by_ceiling) and ceiling[by_ceiling[at]] >= least:
            now = by_ceiling[at:at + step]
            now = now[ceiling[now] >= least]
            chosen = np.sort(docs[np.concatenate([order[starts[g]:ends[g]] for g in now])])
            score = self._scores(chosen, rows, times)
            good = score >= max(least, 1)
            best = sorted(best + list(zip(score[good].tolist(), (-self.ids[chosen[good]]).tolist())), reverse=True)[:top]
            least = best[-1][0] if len(best) == top else 1
            at, step = at + step, min(step * 2, 64)
        return best

    def _scores(self, chosen: np.ndarray, rows: np.ndarray, times: np.ndarray) -> np.ndarray:
        score = np.zeros(len(chosen), np.int64)
        for r, c in zip(rows.tolist(), times.tolist()):
            held = self.doc[self.first[r]:self.last[r]]
            at = np.searchsorted(held, chosen)
            at[at == len(held)] = 0
            hit = held[at] == chosen
            score[hit] += c * self.impact[self.first[r]:self.last[r]][at[hit]]
        return score


def _blocks(batches: Iterator[pa.RecordBatch], block_docs: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= block_docs:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def search(posted: DataFrame, queries: list[tuple[int | None, list[int], list[int]]], n_docs: int, n_all: int,
           weight: np.ndarray, top: int = TOP, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item, doc_id, score: per task the ``top`` best documents of each query, given as
    (item_id, ascending term numbers, occurrences)."""
    asked = [(np.array(t, np.int64), np.array(c, np.int64)) for _, t, c in queries]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        for rows in _blocks(batches, block_docs):
            ids = rows["doc_id"].combine_chunks().fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            lists = rows["t"].combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            block = Block(ids, rows["n"].to_numpy(), np.repeat(np.arange(len(ids)), sizes),
                          lists.flatten().to_numpy().astype(np.int64),
                          rows["tf"].combine_chunks().flatten().to_numpy().astype(np.int64), n_docs, n_all, weight)
            for k, (wanted, times) in enumerate(asked):
                best[k] = block.search(wanted, times, best[k], top)
        found = [(k, s, None if -i == _NO_ID else -i) for k, rows in enumerate(best) for s, i in rows]
        item, score, doc = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()),
                                          pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return posted.select("doc_id", "n", "t", "tf").mapInArrow(rank, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, chunk_terms: int = CHUNK_TERMS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of each item with a
    score above 0, equal scores by ascending doc_id."""
    by_item = stored(item_terms(items), "ranked_items")
    n_chunks = chunks(by_item, chunk_terms)
    spark, found = docs.sparkSession, []
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for k in range(n_chunks):
        part = by_item.where(F.pmod(F.xxhash64("item_id"), F.lit(n_chunks)) == k).collect()
        vocabulary = sorted({r.term for r in part})
        number = {t: j for j, t in enumerate(vocabulary)}
        asked: dict = {}
        for r in part:
            asked.setdefault(r.item_id, []).append((number[r.term], r.n))
        queries = [(i, *zip(*sorted(ts))) for i, ts in asked.items()]
        posted = stored(postings(docs, vocabulary), "ranked_postings")
        n_docs, n_all, weight = weights(posted, len(vocabulary))
        names = spark.createDataFrame([(j, q[0]) for j, q in enumerate(queries)],
                                      f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        lists = search(posted, queries, n_docs, n_all, weight, top, block_docs)
        salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
        lists = lists.withColumn("place", F.row_number().over(salted)).where(F.col("place") <= top).drop("place")
        place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        lists = lists.withColumn("rank", place).where(F.col("rank") <= top)
        found.append(lists.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


SQL_RANKED = r"""
WITH dt AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
it AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*) AS c FROM it GROUP BY ALL),
p AS (SELECT d, doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
len AS (SELECT d, sum(tf)::BIGINT AS n FROM p GROUP BY d),
stats AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM len),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM p CROSS JOIN stats WHERE term IN (SELECT term FROM q) GROUP BY term, nd),
scored AS (
  SELECT item_id, d, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN len USING (d) CROSS JOIN stats GROUP BY item_id, d, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM scored WHERE score > 0)
SELECT * FROM r WHERE rank <= 10"""
