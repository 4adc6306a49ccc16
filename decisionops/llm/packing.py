"""Hierarchical multi-length sequence packing.

Documents become token ids plus one end id.  Whole windows of ``max_len`` ids
are cut off a document first and are sequences of their own; the rest of a
document (shorter than a window) is routed to the smallest context tier that
holds it (1024, 512, 256, 128).  Each tier is packed: a rest opens a sequence
of its tier and its gap is filled, best fit first, with rests of shorter
tiers; when no whole rest fits, the head of a longer one is cut off for it.
Rests that find no place are laid end to end and cut every ``max_len`` ids,
and the tail of that stream is cut at powers of two, so that no sequence
needs padding.  Sequences of every tier are dealt round-robin to step groups,
so all groups hold the same mix of tiers and, within one sequence per tier,
the same number of tokens.

Only the number of rests of each length (fewer than ``max_len`` counts)
decides the plan: rests of one length are interchangeable, so the plan
places *rank ranges* of a length, and its size depends on ``max_len`` alone.
Every document finds its ranges by its rank among the documents of its length.
Ranks are counted in hash cells, so a length that holds a third of all
documents is spread like any other.

Texts are tokenized once; what later steps need (the CRC of every whole
window, the ids of the rest) is written to the shared folder.

Cases: a null text counts as empty and has the end id only; repeated rows are
separate documents; an empty table gives no rows; texts of any length are cut
into windows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cells_for, small_batches, stored

MAX_LEN = 1024
TIERS = (1024, 512, 256, 128)
END_ID = 0
STEP_TOKENS = 1 << 19
CACHED_WORDS = 300_000          # encoded words that a worker keeps
TOKENIZER = "byte_bpe_50k.json"

# Fixed value: the word pattern of byte-level BPE.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE shows bytes as printable characters: printable Latin-1
    as itself, the others as code points from 256 on, in byte order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in shown}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    return table


class _Words(dict):
    """word -> its ids as little-endian 32-bit bytes, filled on demand."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(self.prefix + word)).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts, equal to ``Tokenizer.from_file(path).encode(text,
    add_special_tokens=False)``.

    Byte-level BPE never merges across words, and the gap before a single
    space is a word boundary unless white space lies on both of its sides, so a
    text can be split at its spaces and the words looked up.  New words are
    encoded by the merge table of the same file; texts with added tokens,
    and files of another kind, go through the tokenizer itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        self.words = self.first = self.core = None
        if self._is_plain_byte_level(spec):
            import tiktoken
            of, added = _byte_of_char(), set(self.added)
            ranks = {bytes(of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
            self.core = tiktoken.Encoding("from_file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.words = _Words(self.core.encode_ordinary, " ")
            self.first = _Words(self.core.encode_ordinary, "")
        self.unsafe = re.compile(r"\s (?=\s|\Z)")

    @staticmethod
    def _is_plain_byte_level(spec: dict) -> bool:
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (spec.get("normalizer") or model.get("type") != "BPE" or model.get("dropout")
                or model.get("ignore_merges") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)):
            return False
        vocab, last = model["vocab"], -1
        for m in model["merges"]:               # the merge order must be the id order
            i = vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1), -1)
            if i <= last:
                return False
            last = i
        return True

    def __call__(self, text: str) -> bytes:
        if self.core is None or any(t in text for t in self.added):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.unsafe.search(text):
            return array("I", self.core.encode_ordinary(text)).tobytes()
        parts = text.split(" ")
        return self.first[parts[0]] + b"".join(map(self.words.__getitem__, parts[1:]))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
              max_len: int = MAX_LEN) -> DataFrame:
    """doc_id, doc_tokens, full_crcs (CRC-32 of every whole window), rest (ids
    after them), rest_n.  Row order within a task is kept."""
    window, end = 4 * max_len, END_ID.to_bytes(4, "little")

    def encode(batches):
        enc = _encoder(tokenizer)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.iloc[lo:lo + 512]
                rows = []
                for doc, text in zip(part["doc_id"], part["text"]):
                    ids = enc(text or "") + end
                    full = len(ids) // window
                    rows.append((doc, len(ids) // 4,
                                 [zlib.crc32(ids[i * window:(i + 1) * window]) for i in range(full)],
                                 ids[full * window:], len(ids) // 4 - full * max_len))
                yield pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "full_crcs", "rest", "rest_n"]).astype(
                    {"doc_id": part["doc_id"].dtype})

    return small_batches(docs).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        encode, "doc_id string, doc_tokens long, full_crcs array<long>, rest binary, rest_n int")


class Plan:
    """Where the rests go.  ``placed``: (rest_n, lo, hi, cut, length, sequence,
    offset): the ids [cut, cut + length) of the rests of length ``rest_n``
    with ranks lo <= rank < hi lie in sequence + (rank - lo) at offset.
    ``streamed``: (rest_n, lo, hi, cut, length, pos): those ids lie in the
    stream from pos + (rank - lo) * length on."""

    def __init__(self, counts: dict[int, int], max_len: int = MAX_LEN, tiers=TIERS):
        self.placed: list[tuple] = []
        self.streamed: list[tuple] = []
        self.max_len = max_len
        self.tier_first: dict[int, tuple[int, int]] = {}      # tier -> (first sequence, sequences)
        self.pool = defaultdict(list)                          # length -> [[rest_n, lo, hi, cut]]
        self.left: list[tuple] = []                            # (length, rest_n, lo, hi, cut) for the stream
        self.sequences = 0
        for n, c in counts.items():
            if n > 0 and c > 0:
                self.pool[n].append([n, 0, c, 0])
        for tier in tiers:
            first = self.sequences
            for length in range(tier, tier // 2, -1):
                for item in self.pool.pop(length, []):
                    self._open(item, length, tier)
            self.tier_first[tier] = (first, self.sequences - first)
        self._stream()

    def _fit(self, gap: int) -> int | None:
        return max((n for n in self.pool if n <= gap), default=None)

    def _take(self, length: int, most: int):
        rest_n, lo, hi, cut = self.pool[length][-1]
        n = min(most, hi - lo)
        if n == hi - lo:
            self.pool[length].pop()
            if not self.pool[length]:
                del self.pool[length]
        else:
            self.pool[length][-1][1] = lo + n
        return rest_n, lo, lo + n, cut

    def _open(self, item, length: int, tier: int) -> None:
        """Open a sequence with each rest of ``item`` and fill the gaps.  Work
        units are ranges of like sequences; ``held`` has what lies in them."""
        rest_n, lo, hi, cut = item
        work = [([(rest_n, lo, hi, cut, length, 0)], hi - lo, tier - length)]
        while work:
            held, n, gap = work.pop()
            if gap == 0:
                for rest_n, lo, _, cut, size, offset in held:
                    self.placed.append((rest_n, lo, lo + n, cut, size, self.sequences, offset))
                self.sequences += n
                continue
            size = self._fit(gap)
            longer = size is None and min((x for x in self.pool if x <= tier // 2), default=None)
            if size is None and not longer:                    # nothing is left to fill with
                self.left += [(size, rest_n, lo, lo + n, cut) for rest_n, lo, _, cut, size, _ in held]
                continue
            rest_n, lo, hi, cut = self._take(size or longer, n)
            k = hi - lo
            if k < n:
                work.append(([(r, a + k, b, c, s, o) for r, a, b, c, s, o in held], n - k, gap))
            if size is None:                                   # cut the head off a longer one
                self.pool[longer - gap].append([rest_n, lo, hi, cut + gap])
                size = gap
            work.append((held + [(rest_n, lo, hi, cut, size, tier - gap)], k, gap - size))

    def _stream(self) -> None:
        """What found no place, end to end; the stream is cut every max_len
        ids, its tail at powers of two."""
        pos = 0
        left = self.left + [(n, *item) for n, items in self.pool.items() for item in items]
        for n, rest_n, lo, hi, cut in sorted(left, reverse=True):
            self.streamed.append((rest_n, lo, hi, cut, n, pos))
            pos += (hi - lo) * n
        self.stream_first, self.stream_windows = self.sequences, pos // self.max_len
        at, tail = self.stream_windows * self.max_len, pos % self.max_len
        self.tail_cuts = []                                    # first id of every tail sequence
        for bit in range(self.max_len.bit_length(), -1, -1):
            if tail >> bit & 1:
                self.tail_cuts.append(at)
                at += 1 << bit
        self.sequences += self.stream_windows + len(self.tail_cuts)
        self.stream_length = pos


def _stream_slot(plan: Plan, pos: Column) -> Column:
    slot = F.least(F.floor(pos / F.lit(plan.max_len)), F.lit(plan.stream_windows))
    for c in plan.tail_cuts[1:]:
        slot = slot + (pos >= F.lit(c)).cast("long")
    return slot.cast("long")


def _slot_start(plan: Plan, slot: Column) -> Column:
    start = slot * F.lit(plan.max_len)
    for i, c in enumerate(plan.tail_cuts):
        start = F.when(slot == F.lit(plan.stream_windows + i), F.lit(c)).otherwise(start)
    return start.cast("long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         max_len: int = MAX_LEN, tiers=TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier, step."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    base = stored(tokenized(docs, id_col, text_col, tokenizer, max_len)
                  .withColumn("row", F.monotonically_increasing_id()), "packing_ids")
    stats = base.groupBy("rest_n").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("full_crcs")).alias("full"),
                                       F.sum("doc_tokens").alias("tokens")).collect()
    plan = Plan({r["rest_n"]: r["n"] for r in stats}, max_len, tiers)
    n_docs = sum(r["n"] for r in stats)
    steps = max(1, -(-sum(r["tokens"] for r in stats) // step_tokens))

    # ranks and running window counts, cell by cell
    cell = F.pmod(F.xxhash64("row"), F.lit(cells_for(n_docs, 20_000, 64))).alias("cell")
    rows = base.select("*", F.size("full_crcs").alias("full_n"), cell)
    per = rows.groupBy("cell", "rest_n").agg(F.count(F.lit(1)).alias("n"), F.sum("full_n").alias("full"))
    rank0 = F.sum("n").over(Window.partitionBy("rest_n").orderBy("cell")) - F.col("n")
    per = (per.withColumn("rank0", rank0).groupBy("cell")
           .agg(F.map_from_entries(F.collect_list(F.struct("rest_n", "rank0"))).alias("ranks0"),
                F.sum("full").alias("full")))
    per = per.select("cell", "ranks0", (F.sum("full").over(Window.orderBy("cell")) - F.col("full")).alias("full0"))
    in_cell = Window.partitionBy("cell").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("full_in", F.coalesce(F.sum("full_n").over(in_cell), F.lit(0)))
            .withColumn("rank_in", F.row_number().over(Window.partitionBy("cell", "rest_n").orderBy("row")) - 1)
            .join(per, "cell")
            .withColumn("rank", F.element_at("ranks0", F.col("rest_n")) + F.col("rank_in")))

    whole = (rows.where("full_n > 0")
             .select("doc_id", "doc_tokens", (F.col("full0") + F.col("full_in")).alias("w"),
                     F.posexplode("full_crcs").alias("i", "ids_crc32"))
             .select("doc_id", (F.col("i") * F.lit(max_len)).cast("long").alias("start"),
                     F.lit(max_len).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                     (F.lit(plan.sequences) + F.col("w") + F.col("i")).cast("long").alias("sequence_id"),
                     F.lit(0).cast("long").alias("offset")))

    # a placed range has a sequence and an offset, a streamed one a position in the stream
    entries = [(*e, None) for e in plan.placed] + [(*e[:5], None, None, e[5]) for e in plan.streamed]
    ranges = spark.createDataFrame(
        entries, "p_rest_n int, lo long, hi long, cut0 long, size long, seq0 long, offset0 long, pos0 long")
    in_range = (F.col("rest_n") == F.col("p_rest_n")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    nth, pos, slot, streamed = F.col("rank") - F.col("lo"), F.col("pos"), F.col("slot"), F.col("pos0").isNotNull()
    last_slot = plan.stream_windows + len(plan.tail_cuts) - 1
    slot_end = F.when(slot == last_slot, F.lit(plan.stream_length)).otherwise(_slot_start(plan, slot + 1))
    slots = F.when(streamed, F.sequence(_stream_slot(plan, pos), _stream_slot(plan, pos + F.col("size") - 1)))
    ids = F.expr("substring(rest, cast(cut * 4 + 1 as int), cast(length * 4 as int))")
    rests = (rows.join(F.broadcast(ranges), in_range)               # the plan is bounded by max_len
             .withColumn("pos", F.col("pos0") + nth * F.col("size"))
             .withColumn("slot", F.explode(F.coalesce(slots, F.array(F.lit(0).cast("long")))))
             .withColumn("a", F.when(streamed, F.greatest(pos, _slot_start(plan, slot))))
             .withColumn("b", F.when(streamed, F.least(pos + F.col("size"), slot_end)))
             .withColumn("cut", F.col("cut0") + F.coalesce(F.col("a") - pos, F.lit(0)))
             .withColumn("length", F.coalesce(F.col("b") - F.col("a"), F.col("size")))
             .select("doc_id", (F.col("full_n") * F.lit(max_len) + F.col("cut")).cast("long").alias("start"), "length",
                     F.crc32(ids).alias("ids_crc32"), "doc_tokens",
                     F.coalesce(F.col("seq0") + nth, F.lit(plan.stream_first) + slot).alias("sequence_id"),
                     F.coalesce(F.col("offset0"), F.col("a") - _slot_start(plan, slot)).alias("offset")))

    tier, within = F.lit(max_len), F.col("sequence_id")
    for t, (first, n) in plan.tier_first.items():
        inside = (F.col("sequence_id") >= first) & (F.col("sequence_id") < first + n)
        tier = F.when(inside, F.lit(t)).otherwise(tier)
        within = F.when(inside, F.col("sequence_id") - first).otherwise(within)
    out = whole.unionByName(rests)
    return out.select(F.col("doc_id").cast(id_type).alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                      "sequence_id", "offset", tier.cast("int").alias("tier"),
                      F.pmod(within, F.lit(steps)).alias("step"))
