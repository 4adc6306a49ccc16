"""Suffix-array removal of byte strings that repeat across a corpus.

Every byte covered by a ``length``-byte string (a *window*) that also starts
anywhere else in the corpus is removed.  A suffix array of the whole corpus
would have to be sorted in one piece, so the corpus is cut into shards that
cannot separate equal windows:

1. The smallest 64-byte gram (by hash) of a window is its anchor.  Equal
   windows have equal anchors.  A maximal run of window starts of a text with
   one anchor value is a *segment*; each window lies in exactly one.  Anchors
   that occur once in the corpus can't have a repeated window.
2. Equal segments of an anchor are combined into one class with a count, so
   copies of a passage never meet one by one.  All windows of a class with two
   occurrences repeat.
3. An anchor with several classes (the edges of a shared passage), or one that
   recurs inside its segment (periodic text), goes to a shard, by anchor: the
   shard's suffix array is built by induced sorting (``suffixes``), and the
   permuted common prefixes tell which windows repeat.
4. An anchor with more classes or bytes than a shard should hold (the edges
   of a passage that a third of all documents share) is not sorted in one
   task: its windows are dealt out by a 128-bit hash of their content in
   packed blocks, counted there, and sent back.  This is exact for any size.
   Windows with very many occurrences (a periodic text, an edge in a third of all
   documents) are counted in the tasks first; they repeat for certain, are marked
   where they are and dealt to no one, so no bucket grows with them.

The window spans found are merged per text and cut out.

Cases: a null text has no bytes; repeated rows repeat each other, so their
windows are removed from all of them; texts shorter than a window keep all
bytes; matches never cross texts; texts of any length are read in blocks that
overlap by a window; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cells_for, small_batches, stored

LENGTH = 200
GRAM = 64
SHARD_BYTES = 256 << 10
GROUP_CLASSES = 200           # an anchor with more classes ...
GROUP_BYTES = 128 << 10       # ... or bytes is dealt out by window
BLOCK = 1 << 21
# A window of a large group that occurs this often (at least a quarter of a million times, and a
# 20,000th of all) is hot.  Windows that a task sees fewer than LOCAL times in half a million are not
# counted; what that can miss of a hot window is under half of its occurrences.
HOT_WINDOWS, HOT_SHARE, LOCAL = 1 << 18, 20_000, 8

_POWERS: dict = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        pair = []
        for x in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, np.uint64(x))
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        _POWERS[base] = tuple(pair)
    return _POWERS[base]


def _gram_hashes(x: np.ndarray, k: int, base: int) -> np.ndarray:
    """Mixed polynomial hash of every k bytes of ``x``."""
    size = 1 << max(22, int(len(x)).bit_length())
    power, inverse = _powers(base, size)
    h = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * power[:len(x)], out=h[1:])
    h = (h[k:] - h[:-k]) * inverse[:len(x) - k + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h


_BASE = 6364136223846793005       # odd multipliers; any odd number serves
_BASE2 = 2862933555777941757


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    m, cur, s = len(h) - w + 1, h, 1
    while 2 * s <= w:
        cur = np.minimum(cur[:-s], cur[s:])
        s *= 2
    return np.minimum(cur[:m], cur[w - s:w - s + m])


def _segments_of_block(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Segments of the texts that lie at [starts, ends) of ``x``: arrays of
    text number, anchor, first and last window start (in ``x``), and whether
    the anchor recurs in the segment."""
    w = length - GRAM + 1
    n_win = len(x) - length + 1
    h = _gram_hashes(x, GRAM, _BASE)
    low = _window_min(h, w)
    text = np.repeat(np.arange(len(starts)), ends - starts)[:n_win]
    ok = np.arange(n_win) + length <= ends[text]
    edge = np.ones(n_win, bool)
    edge[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (ok[1:] != ok[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], n_win) - 1
    keep = ok[first]
    first, last = first[keep], last[keep]
    value = low[first]
    again = np.fromiter((np.count_nonzero(h[a:b + w] == v) > 1 for a, b, v in zip(first, last, value)),
                        bool, len(first))
    return text[first], value.view(np.int64), first, last, again


SEGMENT_SCHEMA = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                            ("again", pa.bool_())])


def _segment_batches(length: int):
    def found(keys, starts, ends, x, shift):
        if len(x) < length:
            return
        no, h, a, b, again = _segments_of_block(x, starts, ends, length)
        off = starts[no] - shift[no]
        yield pa.RecordBatch.from_arrays([pa.array(keys[no]), pa.array(h), pa.array(a - off), pa.array(b - off),
                                          pa.array(again)], schema=SEGMENT_SCHEMA)

    def run(batches):
        for batch in batches:
            col = batch.column("text")
            if not len(col):
                continue
            wide = pa.types.is_large_binary(col.type)
            offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[
                col.offset:col.offset + len(col) + 1].astype(np.int64)
            data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            i = 0
            while i < len(keys):
                # as many whole texts as fit a block, or one long text in overlapping pieces
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
                x = data[offsets[i]:offsets[j]]
                if j > i + 1 or len(x) <= BLOCK:
                    at = offsets[i:j + 1] - offsets[i]
                    yield from found(keys[i:j], at[:-1], at[1:], x, np.zeros(j - i, np.int64))
                else:
                    for p in range(0, len(x) - length + 1, BLOCK):
                        piece = x[p:p + BLOCK + length - 1]
                        yield from found(keys[i:j], np.array([0]), np.array([len(piece)]), piece, np.array([p]))
                i = j

    return run


def _occurrences(batches):
    """Segments of texts (key, text, segs) with a 128-bit hash of their bytes."""
    for batch in batches:
        for key, text, segs in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "segs"))):
            rows = []
            for s in segs:
                d = xxhash.xxh3_128_digest(text[s["a"]:s["b"] + s["length"]])
                rows.append((s["h"], int.from_bytes(d[:8], "little", signed=True),
                             int.from_bytes(d[8:], "little", signed=True), key, s["a"],
                             s["b"] + s["length"] - s["a"], s["n"], s["again"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 7, pa.bool_()))],
                names=["h", "s1", "s2", "key", "a", "size", "n", "again"])


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes covered by windows at sorted ``starts``, as [from, to) runs."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist()))


def _sort_shard(length: int):
    """Windows that repeat within a shard, by its suffix array."""
    from .suffixes import repeated_windows

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hits = repeated_windows([bytes(s) for s in pdf["seg"]], length)
        single = pdf["n"].to_numpy() == 1
        rows = [(h, s1, s2, [{"f": f, "t": t} for f, t in _runs(x, length)])
                for h, s1, s2, x, one in zip(pdf["h"], pdf["s1"], pdf["s2"], hits, single) if one and len(x)]
        return pd.DataFrame(rows, columns=["h", "s1", "s2", "runs"])

    return run


# A window of a large group in a packed block: 128-bit content hash, class, start.
_WINDOW = np.dtype([("x", "<u8"), ("y", "<u8"), ("cls", "<i8"), ("at", "<i4"), ("many", "?")])
_CONTENT = np.dtype([("x", "<u8"), ("y", "<u8")])
_HIT = np.dtype([("cls", "<i8"), ("at", "<i4")])


def _packed(rec: np.ndarray, bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    rec, bucket = rec[order], bucket[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    for a, b in zip(first, np.append(first[1:], len(bucket)) if len(bucket) else []):
        yield int(bucket[a]), rec[a:b].tobytes()


def _window_records(pdf: pd.DataFrame, length: int):
    """Windows of large groups as records, a piece of a segment at a time."""
    for cls, seg, n in zip(pdf["cls"], pdf["seg"], pdf["n"]):
        seg = bytes(seg)
        for p in range(0, len(seg) - length + 1, BLOCK):
            x = np.frombuffer(seg[p:p + BLOCK + length - 1], np.uint8)
            rec = np.zeros(len(x) - length + 1, _WINDOW)
            rec["x"], rec["y"] = _gram_hashes(x, length, _BASE), _gram_hashes(x, length, _BASE2)
            rec["cls"], rec["at"], rec["many"] = cls, np.arange(p, p + len(rec)), n > 1
            yield rec


def _frequent_windows(length: int):
    """(x, y, n): windows that occur ``LOCAL`` times or more among some half a million of a task."""
    def counted(held):
        rec = np.concatenate(held)
        pair = np.empty(len(rec), _CONTENT)
        pair["x"], pair["y"] = rec["x"], rec["y"]
        pair, n = np.unique(pair, return_counts=True)
        pair, n = pair[n >= LOCAL], n[n >= LOCAL]
        return pd.DataFrame({"x": pair["x"].view(np.int64), "y": pair["y"].view(np.int64), "n": n})

    def run(batches):
        held, size = [], 0
        for pdf in batches:
            for rec in _window_records(pdf, length):
                held.append(rec)
                size += len(rec)
                if size >= BLOCK // 4:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    return run


def _is_hot(rec: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether the windows are among ``hot`` (sorted contents)."""
    if not len(hot):
        return np.zeros(len(rec), bool)
    pair = np.empty(len(rec), _CONTENT)
    pair["x"], pair["y"] = rec["x"], rec["y"]
    at = np.minimum(np.searchsorted(hot, pair), len(hot) - 1)
    return hot[at] == pair


def _hot_runs(length: int, hot):
    """Runs of hot windows of each class, found where the class is."""
    def run(batches):
        for pdf in batches:
            rows = []
            for rec in _window_records(pdf[pdf["n"] == 1], length):
                at = rec["at"][_is_hot(rec, hot.value)].astype(np.int64)
                if len(at):
                    rows.append((int(rec["cls"][0]), [{"f": f, "t": t} for f, t in _runs(at, length)]))
            yield pd.DataFrame(rows, columns=["cls", "runs"])

    return run


def _deal_windows(length: int, buckets: int, hot):
    """Other windows of large groups, packed by content hash."""
    def packed(held):
        rec = np.concatenate(held)
        return pd.DataFrame(_packed(rec, rec["x"] % np.uint64(buckets)), columns=["bucket", "block"])

    def run(batches):
        for pdf in batches:
            held, size = [], 0
            for rec in _window_records(pdf, length):
                rec = rec[~_is_hot(rec, hot.value)]
                held.append(rec)
                size += len(rec)
                if size >= BLOCK // 4:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

    return run


def _count_windows(buckets: int):
    """Windows of a block that occur twice, packed by class."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rec = np.concatenate([np.frombuffer(b, _WINDOW) for b in pdf["block"]])
        rec = rec[np.lexsort((rec["y"], rec["x"]))]
        new = np.append(True, (rec["x"][1:] != rec["x"][:-1]) | (rec["y"][1:] != rec["y"][:-1]))
        group = np.cumsum(new) - 1
        times = np.bincount(group, 1 + rec["many"].astype(np.int64))
        rec = rec[(times[group] > 1) & ~rec["many"]]
        hit = np.zeros(len(rec), _HIT)
        hit["cls"], hit["at"] = rec["cls"], rec["at"]
        spread = (hit["cls"].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
        return pd.DataFrame(_packed(hit, spread), columns=["bucket", "block"])

    return run


def _collect_hits(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hit = np.concatenate([np.frombuffer(b, _HIT) for b in pdf["block"]])
        hit = hit[np.lexsort((hit["at"], hit["cls"]))]
        first = np.flatnonzero(np.append(True, hit["cls"][1:] != hit["cls"][:-1]))
        rows = [(int(hit["cls"][a]), [{"f": f, "t": t} for f, t in _runs(hit["at"][a:b].astype(np.int64), length)])
                for a, b in zip(first, np.append(first[1:], len(hit)))]
        return pd.DataFrame(rows, columns=["cls", "runs"])

    return run


RUNS = "runs array<struct<f: long, t: long>>"


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``texts`` (key long: one per text; text binary) -> (held, spans):
    ``held`` (key, text) has the texts that hold a recurring anchor, one row a
    key, ``spans`` (key, f, t) the bytes of repeated windows, not merged."""
    found = stored(texts.where(F.octet_length("text") >= length).mapInArrow(
        _segment_batches(length), "key long, h long, a long, b long, again boolean"), "suffix_segments")
    recurring = (found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
                 .where("n > 1 or again").select("h"))
    per_text = (found.join(recurring, "h", "left_semi")
                .groupBy("key", "h", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
                .groupBy("key").agg(F.collect_list(F.struct(
                    "h", "a", "b", "n", "again", F.lit(length).alias("length"))).alias("segs")))
    held = stored(texts.join(per_text, "key").dropDuplicates(["key"]), "suffix_texts")

    occ = stored(held.mapInArrow(_occurrences, "h long, s1 long, s2 long, key long, a long, size long, n long, "
                                               "again boolean"), "suffix_occurrences")
    classes = occ.groupBy("h", "s1", "s2").agg(F.sum("n").alias("n"), F.max("again").alias("again"),
                                               F.min(F.struct("key", "a", "size")).alias("rep"))
    classes = stored(classes, "suffix_classes")
    groups = classes.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.sum("rep.size").alias("bytes"),
                                      F.max("again").alias("again_in"))
    routed = (classes.join(groups.where("k > 1 or again_in"), "h")
              .withColumn("large", (F.col("k") > GROUP_CLASSES) | (F.col("bytes") > GROUP_BYTES)))
    wanted = (routed.groupBy("rep.key").agg(F.collect_list(F.struct("h", "s1", "s2", "n", "rep.a", "rep.size", "large"))
                                            .alias("reps")))
    cut = F.transform("reps", lambda r: F.struct(
        r["h"].alias("h"), r["s1"].alias("s1"), r["s2"].alias("s2"), r["n"].alias("n"), r["large"].alias("large"),
        F.substring(F.col("text"), (r["a"] + 1).cast("int"), r["size"].cast("int")).alias("seg")))
    segs = stored(held.select("key", "text").join(wanted, "key").select(F.explode(cut).alias("r")).select("r.*")
                  .withColumn("cls", F.monotonically_increasing_id()), "suffix_parts")
    total = segs.groupBy("large").agg(F.sum(F.octet_length("seg")).alias("b")).collect()
    total = {r["large"]: r["b"] for r in total}

    n_shards = cells_for(total.get(False, 0), SHARD_BYTES, 8)
    sorted_runs = (segs.where("not large").withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(n_shards)))
                   .select("shard", "h", "s1", "s2", "n", "seg")
                   .groupBy("shard").applyInPandas(_sort_shard(length), f"h long, s1 long, s2 long, {RUNS}"))
    runs = sorted_runs
    if total.get(True):
        buckets = cells_for(total[True], 1 << 18, 64)
        blocks = "bucket long, block binary"
        parts = segs.where("large").select("cls", "seg", "n")
        # windows with very many occurrences repeat for certain; they are marked where they are
        frequent = max(HOT_WINDOWS, total[True] // HOT_SHARE)
        hot = (parts.mapInPandas(_frequent_windows(length), "x long, y long, n long").groupBy("x", "y")
               .agg(F.sum("n").alias("n")).where(F.col("n") >= frequent // 2).select("x", "y").collect())
        contents = np.array([(r["x"] % (1 << 64), r["y"] % (1 << 64)) for r in hot], _CONTENT)
        hot = texts.sparkSession.sparkContext.broadcast(np.sort(contents))         # at most 2 x HOT_SHARE windows
        if len(contents):
            marked = parts.mapInPandas(_hot_runs(length, hot), f"cls long, {RUNS}")
            runs = runs.unionByName(segs.where("large").select("cls", "h", "s1", "s2").join(marked, "cls").drop("cls"))
        dealt = parts.mapInPandas(_deal_windows(length, buckets, hot), blocks)
        hits = (dealt.groupBy("bucket").applyInPandas(_count_windows(buckets), blocks)
                .groupBy("bucket").applyInPandas(_collect_hits(length), f"cls long, {RUNS}"))
        runs = runs.unionByName(segs.where("large").select("cls", "h", "s1", "s2").join(hits, "cls").drop("cls"))

    # a class seen once: its runs, in its only text; seen more often: all of every occurrence
    once = (classes.where("n = 1").join(runs, ["h", "s1", "s2"])
            .select("rep.key", "rep.a", F.explode("runs").alias("r"))
            .select("key", (F.col("a") + F.col("r.f")).alias("f"), (F.col("a") + F.col("r.t")).alias("t")))
    often = (occ.join(classes.where("n > 1").select("h", "s1", "s2"), ["h", "s1", "s2"], "left_semi")
             .select("key", F.col("a").alias("f"), (F.col("a") + F.col("size")).alias("t")))
    return held.select("key", "text"), once.union(often)


def _cut_out(give_text: bool):
    """(text, spans) -> bytes, removed, runs removed, SHA-256 or text of the rest."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "spans"))):
                kept, merged, at = [], [], 0
                for f, t in sorted((s["f"], s["t"]) for s in spans or ()):
                    if merged and f <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], t)
                    else:
                        merged.append([f, t])
                for f, t in merged:
                    kept.append(text[at:f])
                    at = t
                kept.append(text[at:])
                if give_text:       # a character that a cut splits goes with its removed bytes
                    rest = "".join(p.decode("utf-8", "ignore") for p in kept)
                else:
                    rest = hashlib.sha256(b"".join(kept)).hexdigest()
                rows.append((key, len(text), sum(t - f for f, t in merged), len(merged), rest))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.string()))],
                names=["key", "n_bytes", "n_removed", "n_spans", "rest"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every input column, and ``_key``: a 64-bit hash of id and text."""
    return docs.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col)))


def _changed(keyed: DataFrame, text_col: str, length: int, give_text: bool) -> DataFrame:
    texts = keyed.select(F.col("_key").alias("key"), F.col(text_col).cast("binary").alias("text"))
    held, spans = repeated_spans(small_batches(texts), length)
    spans = spans.distinct().groupBy("key").agg(F.collect_list(F.struct("f", "t")).alias("spans"))
    return held.join(spans, "key").mapInArrow(
        _cut_out(give_text), "key long, n_bytes long, n_removed long, n_spans long, rest string")


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = _keyed(docs.select(id_col, text_col), id_col, text_col)
    whole = stored(keyed.select(F.col(id_col).alias("doc_id"), F.col("_key").alias("key"),
                                F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
                                F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256).alias("sha")),
                   "suffix_whole")
    cut = _changed(keyed, text_col, length, False)
    return whole.join(cut, "key", "left").select(
        "doc_id", F.col("bytes").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("rest", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` (all columns and rows) with repeated windows cut out of the text."""
    keyed = _keyed(docs, id_col, text_col)
    cut = _changed(keyed, text_col, length, True).select(F.col("key").alias("_cut_key"), F.col("rest").alias("_rest"))
    out = keyed.join(cut, F.col("_key") == F.col("_cut_key"), "left")
    return out.withColumn(text_col, F.coalesce("_rest", F.col(text_col))).select(docs.columns)
