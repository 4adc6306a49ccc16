"""Minimax contiguous sharding (native DataFrame operations only).

Documents with equal texts form an atomic group.  Groups are ordered by a
64-bit text hash, and the ordered groups are cut into ``n_shards`` contiguous
runs so that the largest run (in bytes) is as small as any contiguous cut of
that order allows.  The smallest feasible capacity is found by binary search
with a greedy check.

The greedy check needs prefix sums of group sizes, which grow with the
corpus, so the driver never holds them.  It holds *cells*: ranges of the hash
order with their byte sum and group count.  Treating every cell as one group
bounds the capacity from above, treating every unresolved cell as divisible
bounds it from below; only the cells in which a cut can still fall are split
further, in one aggregation per round, until both bounds meet.  The state is
a few times ``2**FIRST_BITS`` cells whatever the corpus size.

Cases: null text has zero bytes, CRC 0 and is a group of its own; repeated
rows are separate documents of one group; an empty table gives no rows; a
group larger than the mean shard gets a shard to itself (a shard may then be
smaller than the others, or empty when there are fewer groups than shards);
other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cells_for, stored

KEY_BITS = 62          # bits of the order key
FIRST_BITS = 13        # first round: 8192 cells
STEP_BITS = 7          # each later round splits a cell 128 ways


def group_key(text_col: str):
    """Order key of a text: the upper 62 bits of its 64-bit hash.  Different
    texts that share a key (about n^2 / 2^63 pairs) merely stay together."""
    return F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 64 - KEY_BITS)


class Cells:
    """Ranges of the key order: start key, width in bits, bytes, groups."""

    def __init__(self, start, width, size, groups):
        order = np.argsort(start, kind="stable")
        self.start, self.width = start[order], width[order]
        self.size, self.groups = size[order], groups[order]
        self.end = np.cumsum(self.size)                      # bytes up to and with the cell
        self.total = int(self.end[-1]) if len(self.end) else 0

    def cuts(self, capacity: int, n: int, divisible: bool) -> list[int] | None:
        """Greedy byte positions of the n-1 cuts, None when n runs don't suffice."""
        pos, out = 0, []
        for _ in range(n):
            target = pos + capacity
            if target >= self.total:
                return out + [self.total] * (n - 1 - len(out))
            i = int(np.searchsorted(self.end, target, side="right"))     # cell that holds the target
            at = int(self.end[i - 1]) if i else 0
            if divisible and self.groups[i] > 1:
                at = target
            if at <= pos:
                return None
            out.append(at)
            pos = at
        return None

    def smallest(self, n: int, divisible: bool) -> int:
        """Binary search for the smallest feasible capacity."""
        lo, hi = max(1, -(-self.total // n)), max(1, self.total)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.cuts(mid, n, divisible) is not None else (mid + 1, hi)
        return lo

    def undecided(self, low: int, high: int, n: int) -> np.ndarray:
        """Unresolved cells in which a cut can fall for a capacity in [low, high]."""
        first, last = self._walk(low, n, False), self._walk(high, n, True)
        hit = np.zeros(len(self.end), bool)
        for a, b in zip(first, last):
            i = int(np.searchsorted(self.end, a, side="right"))
            j = int(np.searchsorted(self.end, b, side="right"))
            hit[i:j + 1] = True
        return hit & (self.groups > 1)

    def _walk(self, capacity: int, n: int, divisible: bool) -> list[int]:
        pos, out = 0, []
        for _ in range(n - 1):
            target = min(pos + capacity, self.total)
            i = int(np.searchsorted(self.end, target, side="right"))
            at = int(self.end[i - 1]) if i else 0
            if divisible and i < len(self.end) and self.groups[i] > 1:
                at = target
            pos = max(pos, at)
            out.append(pos)
        return out

    def even(self, capacity: int, n: int) -> list[int]:
        """Index of the first cell of shards 1..n-1: every run is at most
        ``capacity`` and as near to an equal share of what is left as the cell
        ends allow, as long as the rest still fits the runs that are left."""
        firsts, i, count = [], 0, len(self.end)
        need = self._runs_needed(capacity)
        for left in range(n, 1, -1):
            pos = int(self.end[i - 1]) if i else 0
            share = pos + -(-(self.total - pos) // left)
            most = int(np.searchsorted(self.end, pos + capacity, side="right"))
            j = min(most, int(np.searchsorted(self.end, share, side="right")))
            if j < most and share - (int(self.end[j - 1]) if j else 0) > int(self.end[j]) - share:
                j += 1
            if j == i and i < count:
                j = min(most, i + 1)
            while j < most and need[j] > left - 1:
                j += 1
            i = j
            firsts.append(i)
        return firsts

    def _runs_needed(self, capacity: int) -> np.ndarray:
        """Runs that greedy filling needs from each cell on (one backward pass)."""
        n = len(self.end)
        before = np.concatenate(([0], self.end))
        to = np.searchsorted(self.end, before[:-1] + capacity, side="right")
        need = np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            need[i] = need[to[i]] + 1
        return need


def _collect(cells: DataFrame):
    got = cells.toArrow()
    return tuple(got.column(c).to_numpy().astype(np.int64) for c in ("cell", "size", "n"))


def minimax_bounds(groups: DataFrame, n_shards: int) -> tuple[int, list[int], int]:
    """(smallest feasible capacity, first key of shards 1..n-1, documents) for
    ``groups`` (gkey, size, n_docs)."""
    shift = KEY_BITS - FIRST_BITS
    per = (F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    top = groups.groupBy(F.shiftright("gkey", shift).alias("cell")).agg(*per, F.sum("n_docs").alias("docs")).toArrow()
    docs = sum(top.column("docs").to_pylist())
    cell, size, n = (top.column(c).to_numpy().astype(np.int64) for c in ("cell", "size", "n"))
    cells = Cells(cell << shift, np.full(len(cell), shift), size, n)
    if not len(cell):
        return 0, [1 << KEY_BITS] * (n_shards - 1), 0
    spark = groups.sparkSession
    while True:
        high, low = cells.smallest(n_shards, False), cells.smallest(n_shards, True)
        open_ = cells.undecided(low, high, n_shards)
        if low == high or not open_.any():
            break
        parts = [(cells.start[~open_], cells.width[~open_], cells.size[~open_], cells.groups[~open_])]
        for width in sorted(set(cells.width[open_].tolist())):
            chosen = (cells.start[open_ & (cells.width == width)] >> width).tolist()
            below = max(0, width - STEP_BITS)
            wanted = F.broadcast(spark.createDataFrame([(int(x),) for x in chosen], "cell0 long"))
            split = (groups.withColumn("cell0", F.shiftright("gkey", width)).join(wanted, "cell0")
                     .groupBy(F.shiftright("gkey", below).alias("cell")).agg(*per))
            c, s, k = _collect(split)
            parts.append((c << below, np.full(len(c), below), s, k if below else np.ones(len(c), np.int64)))
        cells = Cells(*(np.concatenate(x) for x in zip(*parts)))
    firsts = cells.even(high, n_shards)
    keys = [int(cells.start[i]) if i < len(cells.start) else 1 << KEY_BITS for i in firsts]
    return high, keys, docs


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n_shards: int = 40, overhead: int = 16) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + overhead), text_crc32,
    gkey, shard, slot (gapless from 0 within the shard)."""
    base = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("long").alias("text_crc32"),
        group_key(text_col).alias("gkey")), "shard_base")
    groups = stored(base.groupBy("gkey").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_docs")),
                    "shard_groups")
    _, keys, n_docs = minimax_bounds(groups, n_shards)
    shard = F.lit(0)
    for k in keys:
        shard = shard + (F.col("gkey") >= F.lit(k)).cast("int")
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells_for(n_docs))).alias("cell")
    placed = base.select("*", shard.cast("int").alias("shard"), cell)
    before = (placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("cell"))
                                        - F.col("n")).alias("before")))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "gkey")) - 1
    return (placed.withColumn("rank", rank).join(before, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "gkey", "shard",
                    (F.col("before") + F.col("rank")).alias("slot")))
