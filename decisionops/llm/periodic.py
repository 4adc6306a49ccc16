"""Periodic runs of words by a branching-tandem test on enhanced suffix arrays.

A run is a stretch of consecutive words with smallest period q and at least
max(``MIN_WORDS``, ``MIN_EXPONENT`` * q) words that no neighbouring word extends.

* The documents of a batch are one sequence of symbols; equal words of two
  documents are different symbols, so nothing matches across documents.
* A bigram of a run occurs at least three times in it.  The sequence is cut where
  a bigram occurs less often in its document; no run crosses such a cut, and
  pieces that are too short for a run are left out (prose nearly vanishes here).
* Suffix array by prefix doubling, refining unresolved groups only; inverse array
  (ISA); longest common prefixes (LCP).
* LCP intervals come from one pass with a stack that holds bounds and the largest
  child, no tree nodes.  In an interval of depth d every suffix i outside the
  largest child is tested: ISA[i + d] in the interval makes a square at i,
  ISA[i - d] in the interval one at i - d.  A square counts when it branches: the
  word after it does not go on with the period.  The smaller-child rule makes
  O(n log n) tests.
* A branching square ends where its run ends.  It is rotated left as long as the
  words agree, which gives the run's start; squares of multiples of the period
  fall on the same run, which keeps the smallest.

Everything of a document happens in its row: no shuffle, no skew by key.  Memory
is bounded by a batch (``BATCH_BYTES`` of text) or the longest document.

Cases: null, empty and blank texts have no words and no runs; a null id is not
repeated artificially (``planted``); repeated rows are rows of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

MIN_WORDS = 6
MIN_EXPONENT = 4
BATCH_BYTES = 4 << 20


# ---- suffix array, LCP -------------------------------------------------------

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s`` (ints >= 0) by prefix doubling: each round sorts only
    the groups whose suffixes still agree."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    new_group = np.empty(n, bool)
    new_group[:1] = True
    new_group[1:] = s[sa[1:]] != s[sa[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(new_group, np.arange(n), 0))
    open_at = np.flatnonzero(~(new_group & np.append(new_group[1:], True)))      # places in groups of two or more
    h = 1
    while len(open_at):
        at = sa[open_at]
        group, follow = rank[at], rank[np.minimum(at + h, n)]
        order = np.lexsort((follow, group))
        at, group, follow = at[order], group[order], follow[order]
        sa[open_at] = at
        first = np.empty(len(at), bool)
        first[0] = True
        first[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[at] = open_at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        open_at = open_at[~(first & np.append(first[1:], True))]
        h *= 2
    return sa


def lcp_array(s: np.ndarray, sa: np.ndarray, isa: np.ndarray) -> np.ndarray:
    """lcp[k]: common prefix of suffixes sa[k-1] and sa[k] (0 for k = 0), from the
    permuted values, which fall by one at most from a position to the next."""
    n = len(s)
    prior = np.full(n, n, np.int64)
    prior[sa[1:]] = sa[:-1]
    words, before = s.tolist(), prior.tolist()
    words.append(-1)
    out, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j == n:
            h = 0
            continue
        top = n - (i if i > j else j)
        while h < top and words[i + h] == words[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return np.array(out, np.int64)[sa]


def smaller_children(lcp: np.ndarray, max_depth: int) -> tuple[np.ndarray, ...]:
    """Places of the suffixes outside the largest child of every LCP interval, as
    ranges: (from, to, depth, left, right), ends included."""
    ranges: list[tuple[int, int, int, int, int]] = []
    depth, left, big_l, big_r = [0], [0], [0], [0]            # the stack; big: largest child so far

    def close(right: int) -> tuple[int, int]:
        d, lb, bl, br = depth.pop(), left.pop(), big_l.pop(), big_r.pop()
        if 0 < d <= max_depth:
            if lb < bl:
                ranges.append((lb, bl - 1, d, lb, right))
            if br < right:
                ranges.append((br + 1, right, d, lb, right))
        return lb, right

    def child(lb: int, rb: int) -> None:
        if rb - lb > big_r[-1] - big_l[-1]:
            big_l[-1], big_r[-1] = lb, rb

    for k, d in enumerate(lcp.tolist() + [0]):
        if k == 0:
            continue
        lb, last = k - 1, None
        while d < depth[-1]:
            last = close(k - 1)
            lb = last[0]
            if d <= depth[-1]:
                child(*last)
                last = None
        if d > depth[-1]:
            depth.append(d)
            left.append(lb)
            inner = last or (lb, lb)
            big_l.append(inner[0])
            big_r.append(inner[1])
    return tuple(np.array(ranges, np.int64).reshape(-1, 5).T)


# ---- branching squares and runs ----------------------------------------------

def branching_squares(s: np.ndarray, max_depth: int, test_rows: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, depth) of the squares of ``s`` that the next symbol does not carry on."""
    n = len(s)
    sa = suffix_array(s)
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lo, hi, d, left, right = smaller_children(lcp_array(s, sa, isa), max_depth)
    after = np.append(s, -1)
    at, step = 0, np.cumsum(hi - lo + 1)
    while at < len(lo):
        end = max(at + 1, int(np.searchsorted(step, (step[at - 1] if at else 0) + test_rows, "right")))
        size = (hi - lo + 1)[at:end]
        first = np.repeat(np.cumsum(size) - size, size)
        i = sa[np.repeat(lo[at:end], size) + np.arange(len(first)) - first]
        depth, lb, rb = (np.repeat(x[at:end], size) for x in (d, left, right))
        for start, other in ((i, i + depth), (i - depth, i - depth)):
            ok = (other >= 0) & (other < n)
            b, o, dd = start[ok], other[ok], depth[ok]
            place = isa[o]
            found = (place >= lb[ok]) & (place <= rb[ok])
            b, dd = b[found], dd[found]
            branch = after[b + dd] != after[np.minimum(b + 2 * dd, n)]
            yield b[branch], dd[branch]
        at = end


def _agree_left(s: np.ndarray, i: int, d: int) -> int:
    """Smallest start of the stretch of period d that holds [i, i + d)."""
    width = 64
    while i > 0:
        lo = max(0, i - width)
        miss = np.flatnonzero(s[lo:i] != s[lo + d:i + d])
        if len(miss):
            return lo + int(miss[-1]) + 1
        i, width = lo, width * 4
    return i


def runs_of(s: np.ndarray, piece_end: np.ndarray, max_piece: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of a sequence whose pieces end in symbols of their own."""
    if not len(s):
        return []
    squares = list(branching_squares(s, max_piece // MIN_EXPONENT))
    start, depth = (np.concatenate(x) for x in zip(*squares)) if squares else (np.zeros(0, np.int64),) * 2
    end = start + 2 * depth
    first = end - MIN_EXPONENT * depth                     # the run has to reach back to here
    ok = (first >= 0) & (s[first] == s[first + depth])
    ok &= s[np.maximum(start - 1, 0)] == s[np.maximum(start - 1, 0) + depth]       # exponent over 2 needs one step at least
    start, depth, end = start[ok], depth[ok], end[ok]
    order = np.lexsort((start, depth, end))
    out: list[tuple[int, int, int]] = []
    for i, d, e in zip(start[order].tolist(), depth[order].tolist(), end[order].tolist()):
        k = len(out) - 1
        while k >= 0 and out[k][1] == e and not (out[k][0] <= i and d % out[k][2] == 0):
            k -= 1
        if k >= 0 and out[k][1] == e:
            continue                                       # a multiple of the period of a run that is known
        out.append((_agree_left(s, i, d), e, d))
    return [r for r in out if r[1] - r[0] >= max(MIN_WORDS, MIN_EXPONENT * r[2])]


def _pieces(doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The stretches that can hold a run, each followed by a symbol of its own:
    (symbols, position of each symbol or -1, longest stretch)."""
    n = len(word)
    key = doc * (int(word.max(initial=0)) + 1) + word
    _, sym = np.unique(key, return_inverse=True)
    pair = sym[:-1] * np.int64(sym.max(initial=0) + 1) + sym[1:]
    _, inv, count = np.unique(pair, return_inverse=True, return_counts=True)
    joined = (doc[1:] == doc[:-1]) & (count[inv] >= MIN_EXPONENT - 1)
    edge = np.flatnonzero(~joined) + 1
    begin, end = np.append(0, edge), np.append(edge, n)
    size = end - begin
    keep = size >= MIN_WORDS
    begin, size = begin[keep], size[keep]
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    offset = np.cumsum(size + 1) - (size + 1)
    total = int((size + 1).sum())
    at = np.full(total, -1, np.int64)
    inside = np.ones(total, bool)
    inside[offset + size] = False
    at[inside] = np.repeat(begin - offset, size) + np.flatnonzero(inside)
    out = np.empty(total, np.int64)
    out[inside] = sym[at[inside]]
    out[~inside] = int(sym.max()) + 1 + np.arange(len(begin))
    return out, at, int(size.max())


def batch_runs(docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, given as arrays of word numbers,
    by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    sizes = np.array([len(d) for d in docs], np.int64)
    if not sizes.sum():
        return out
    doc = np.repeat(np.arange(len(docs)), sizes)
    base = np.cumsum(sizes) - sizes
    s, at, longest = _pieces(doc, np.concatenate(docs).astype(np.int64))
    for b, e, q in runs_of(s, at, longest):
        first = int(at[b])
        k = int(doc[first])
        out[k].append((first - int(base[k]), e - b, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


# ---- documents ----------------------------------------------------------------

def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Word order of a document that is made periodic (a tenth of the ids), else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True where no run holds the word after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of about ``BATCH_BYTES`` together, or of one longer text."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0), batch.column(1)):
            raw = t.as_buffer() if t.is_valid else b""
            if size and size + len(raw) > BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i.as_py())
            texts.append(bytes(raw))
            size += len(raw)
        if ids:
            yield ids, texts


def texts_runs(ids: list, texts: list[bytes], plant: bool) -> Iterator[tuple]:
    """(id, runs as (start, length, period), collapsed text) of each text."""
    split = [raw.split() for raw in texts]                # bytes are split at \x20, \x09-\x0d
    codes, _ = pd.factorize(np.array([w for words in split for w in words], object))
    numbers, at = [], 0
    for k, (i, words) in enumerate(zip(ids, split)):
        own = codes[at:at + len(words)]
        at += len(words)
        order = planted(len(words), i) if plant else None
        if order is not None:
            own = own[order]
            split[k] = [words[j] for j in order.tolist()]
        numbers.append(own)
    for i, words, runs in zip(ids, split, batch_runs(numbers)):
        kept = words
        if runs:
            kept = [w for w, k in zip(words, kept_words(len(words), runs).tolist()) if k]
        yield i, runs, b" ".join(kept)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _as_text(texts: tuple[bytes, ...]) -> pa.Array:
    """The bytes as they are, valid UTF-8 or not."""
    return pc.cast(pa.array(texts, pa.binary()), options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), collapsed (the words
    that stay, joined by one space).  ``plant`` makes a tenth of the documents periodic first."""
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            _, runs, collapsed = zip(*texts_runs(ids, texts, plant))
            found = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], pa.list_(_RUN))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), found, _as_text(collapsed)],
                                             ["doc_id", "runs", "collapsed"])

    return rows.mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_report(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; ties: smallest
    start, then period) and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"),
                                                              (-r["period"]).alias("q"))))
    listing = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.q")).alias("period"),
        F.expr("(1000 * best.length) div (-best.q)").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
