"""Connected components of an edge table.

Edges are first contracted in chunks of at most ``CHUNK`` edges, each in a task
of its own: a chunk's components become stars, which shortens chains before
anything is joined.  When there is one chunk, that is the result.  Otherwise
large-star / small-star rounds go on from the stars until nothing changes.

Each round joins every edge with the smallest neighbour of one end (a partial
aggregate, so a hub with millions of edges is combined before the shuffle; the
join back on a hub key is left to the skew-join splitting of adaptive
execution).  Rounds are written to the shared folder, so a lost executor never
replays the loop, and the edges never pass through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


CHUNK = 500_000


def _contract(batches):
    """Stars (node a, smallest node b of its component) of a chunk of edges."""
    chunk = [pdf for pdf in batches if len(pdf)]
    if not chunk:
        return
    edges = pd.concat(chunk, ignore_index=True)
    nodes, ends = np.unique(edges[["a", "b"]].to_numpy(np.int64).ravel(), return_inverse=True)
    u, v = ends[0::2], ends[1::2]
    root = np.arange(len(nodes))                 # positions are in id order, so the minimum is the smallest id
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        for end in (u, v, root[u], root[v]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = root != np.arange(len(nodes))
    yield pd.DataFrame({"a": nodes[linked], "b": nodes[root[linked]]})


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(m, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b: link a node and its smaller neighbours to the smallest."""
    m = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (edges.join(m, "a").where(F.col("b") != F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(m.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b longs, any direction; loops and repeats allowed) ->
    (node, root): the smallest node of the component, for every node that has
    an edge to another one."""
    e = stored(edges.where(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    chunks = -(-e.count() // CHUNK)
    if chunks:
        e = stored(e.repartition(chunks).mapInPandas(_contract, "a long, b long"), name)
    seen = _fingerprint(e) if chunks > 1 else None
    for _ in range(max_rounds):
        if chunks <= 1:
            break
        e = stored(_small_star(_large_star(e)), name)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
