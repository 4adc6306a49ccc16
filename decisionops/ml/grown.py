"""Forests and boosted trees of one data split, grown inside tasks.

A level-by-level fit sends histograms of all open nodes through the driver; with
hundreds of deep trees, or hundreds of short rounds, that and the jobs are nearly all
of its time.  Here the rows of a split are binned and packed once into one row (a byte a
value), and a task grows whole trees over it: some trees of a forest, or all rounds of a
boosted fit.  Fold fits score their held rows where the trees are, so no model leaves the
task; fitted models are stored in Spark's own format and loaded as Spark models.

The trees are those of ``RandomForestClassifier`` and ``GBTClassifier``: thresholds between
at most 32 weighted quantile bins (of all rows), Gini or variance gain, least rows of a
child, a new draw of features for every node, Poisson bootstrap or rows drawn without
replacement, twins of equal prediction merged, log loss.
Draws depend on the seed, the tree and the order of the ids only.

A split with more than ``TASK_CELLS`` training values does not fit in a task: ``fits`` says so
and the caller takes Spark's distributed fit.
"""

from __future__ import annotations

import json
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_table_path

BINS = 32                       # 5 bits of a sort key
MOST_COPIES = 15                # of a row in a bootstrap: 4 bits of a sort key
TASK_CELLS = 16_000_000         # training rows x slots of a split that is packed into one row
TREES_PER_TASK = (4, 64)
TASK_WORK = 20_000_000          # rows x features of a node x trees of a task

NODE = ("struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
        "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, "
        "numCategories int>>")


# ---- what is fitted ---------------------------------------------------------------

def spec(stage) -> dict | None:
    """What a tree estimator asks for; None for other stages and for parameters that are not grown here."""
    if type(stage) not in (RandomForestClassifier, GBTClassifier):
        return None
    if stage.getMaxBins() != BINS or stage.getMinInfoGain() != 0.0 or stage.getMinWeightFractionPerNode() != 0.0:
        return None
    out = {"depth": stage.getMaxDepth(), "least": stage.getMinInstancesPerNode(), "seed": stage.getSeed(),
           "features": stage.getFeatureSubsetStrategy(), "sample": stage.getSubsamplingRate(),
           "weighted": stage.isSet("weightCol"), "vector": stage.getFeaturesCol()}
    if isinstance(stage, RandomForestClassifier):
        known = stage.getImpurity() == "gini" and out["sample"] == 1.0
        return out | {"kind": "forest", "trees": stage.getNumTrees(), "bootstrap": stage.getBootstrap()} if known else None
    known = not out["weighted"] and stage.getLossType() == "logistic" and not stage.isSet("validationIndicatorCol")
    return out | {"kind": "boosting", "trees": stage.getMaxIter(), "rate": stage.getStepSize()} if known else None


def features_of_node(strategy: str, d: int, forest: bool) -> int:
    if strategy == "auto":
        strategy = "sqrt" if forest else "all"
    k = {"all": d, "sqrt": np.ceil(np.sqrt(d)), "log2": max(1, np.ceil(np.log2(d))), "onethird": np.ceil(d / 3)}.get(strategy)
    if k is None:
        k = np.ceil(float(strategy) * d) if "." in strategy else float(strategy)
    return int(min(d, max(1, k)))


# ---- bins -------------------------------------------------------------------------

def split_points(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Midpoints of all neighbouring values, or of those nearest to equal weights a bin."""
    values, at = np.unique(x, return_inverse=True)
    if len(values) <= BINS:
        return (values[:-1] + values[1:]) / 2.0
    c = np.cumsum(np.bincount(at, weight))
    both, stride = c[:-1] + c[1:], c[-1] / BINS
    out, i, target = [], 0, stride
    while len(out) < BINS - 1:
        i = max(i + 1, int(np.searchsorted(both, 2.0 * target, side="right")) + 1)
        if i >= len(values):
            break
        out.append((values[i - 1] + values[i]) / 2.0)
        target += stride
    return np.array(out)


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1).astype(np.uint8)


# ---- one tree ---------------------------------------------------------------------

def _subsets(rng, nodes: int, d: int, k: int) -> np.ndarray | None:
    """``k`` of ``d`` features for every node (Floyd's draw without replacement); None: all."""
    if k == d:
        return None
    out = np.empty((nodes, k), np.int64)
    for j in range(k):
        top = d - k + j
        pick = rng.integers(0, top + 1, nodes)
        if j:
            pick[(out[:, :j] == pick[:, None]).any(1)] = top
        out[:, j] = pick
    return out


def _class_gain(l0, l1, n0, n1, cw):
    """Sum of squares over weight, of both sides; the Gini gain but for constants of the node."""
    a0, a1 = l0 * cw[0], l1 * cw[1]
    b0, b1 = n0 * cw[0] - a0, n1 * cw[1] - a1
    return (a0 * a0 + a1 * a1) / (a0 + a1) + (b0 * b0 + b1 * b1) / (b0 + b1)


def _class_splits(flat, base, node, copies, y, n0, n1, cw, subset, d, least):
    """Best (score, feature, bin, left counts) of every node over its features."""
    m = len(n0)
    best, feature, cut = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64)
    left0, left1 = np.zeros(m), np.zeros(m)
    total = n0 + n1
    dense = len(node) >= 16 * m
    if not dense:
        before, before1 = np.cumsum(total) - total, np.cumsum(n1) - n1
        low = (y.astype(np.uint32) << np.uint32(4)) | copies.astype(np.uint32)
        high = node.astype(np.uint32) << np.uint32(10)
    for slot in range(d if subset is None else subset.shape[1]):
        of = np.full(m, slot) if subset is None else subset[:, slot]
        b = flat.take(base + (slot if subset is None else of[node]))
        if dense:
            key = ((node * BINS + b) << 1) + y
            c = np.bincount(key, copies, m * BINS * 2).reshape(m, BINS, 2).cumsum(1)[:, :-1]
            l0, l1 = c[..., 0], c[..., 1]
            raw = l0 + l1
            ok = (raw >= least) & (total[:, None] - raw >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(ok, _class_gain(l0, l1, n0[:, None], n1[:, None], cw), -np.inf)
            j = score.argmax(1)
            at = np.arange(m)
            top, nodes, bins, p0, p1 = score[at, j], at, j, l0[at, j], l1[at, j]
        else:
            key = high | (b.astype(np.uint32) << np.uint32(5)) | low
            key.sort()
            group = key >> np.uint32(5)
            end = np.flatnonzero(group[1:] != group[:-1])
            nd = (group >> np.uint32(5)).astype(np.int64)
            end = end[nd[end] == nd[end + 1]]
            n = (key & np.uint32(15)).astype(np.int64)
            of_end = nd[end]
            raw = np.cumsum(n)[end] - before[of_end]
            l1 = np.cumsum(np.where(key & np.uint32(16), n, 0))[end] - before1[of_end]
            ok = (raw >= least) & (total[of_end] - raw >= least)
            end, of_end, raw, l1 = end[ok], of_end[ok], raw[ok], l1[ok]
            if not len(end):
                continue
            score = _class_gain(raw - l1, l1, n0[of_end], n1[of_end], cw)
            start = np.flatnonzero(np.r_[True, of_end[1:] != of_end[:-1]])
            high_score = np.maximum.reduceat(score, start)
            hit = np.flatnonzero(score == np.repeat(high_score, np.diff(np.r_[start, len(score)])))
            hit = hit[np.r_[True, of_end[hit][1:] != of_end[hit][:-1]]]
            top, nodes, bins = score[hit], of_end[hit], (group[end[hit]] & np.uint32(31)).astype(np.int64)
            p0, p1 = (raw - l1)[hit], l1[hit]
        up = top > best[nodes]
        at = nodes[up]
        best[at], feature[at], cut[at], left0[at], left1[at] = top[up], of[at], bins[up], p0[up], p1[up]
    return best, feature, cut, left0, left1


def _tree(levels: list[dict]) -> dict:
    """Level arrays as one tree; twins of equal prediction are merged, what is below goes."""
    offsets = np.cumsum([0, *[len(v["left"]) for v in levels]])
    t = {k: np.concatenate([v[k] for v in levels]) for k in levels[0]}
    leaf = t["left"] < 0
    for lo, hi in reversed(list(zip(offsets[:-2], offsets[1:-1]))):
        at = lo + np.flatnonzero(~leaf[lo:hi])
        a = t["left"][at]
        leaf[at[leaf[a] & leaf[a + 1] & (t["prediction"][a] == t["prediction"][a + 1])]] = True
    reached = np.zeros(len(leaf), bool)
    reached[0] = True
    for lo, hi in zip(offsets[:-2], offsets[1:-1]):
        a = t["left"][lo + np.flatnonzero(reached[lo:hi] & ~leaf[lo:hi])]
        reached[a] = reached[a + 1] = True
    new = np.cumsum(reached) - 1
    t["left"] = np.where(leaf, -1, new[np.maximum(t["left"], 0)])
    return {k: v[reached] for k, v in t.items()}


def grow_classes(bins, y, copies, cw, rng, k, least, depth) -> dict:
    """A Gini tree level by level; ``copies``: how often each row is in the sample."""
    d, flat = bins.shape[1], bins.reshape(-1)
    rows = np.flatnonzero(copies)
    base, copies, y = rows * d, copies[rows], y[rows]
    node = np.zeros(len(rows), np.int64)
    n1 = np.array([float(copies[y == 1].sum())])
    n0 = np.array([float(copies.sum())]) - n1
    levels, next_id = [], 1
    for level in range(depth + 1):
        w0, w1 = n0 * cw[0], n1 * cw[1]
        m = len(n0)
        out = {"left": np.full(m, -1, np.int64), "feature": np.full(m, -1, np.int64), "cut": np.zeros(m, np.int64),
               "gain": np.full(m, -1.0), "prediction": (w1 > w0).astype(np.float64), "a": w0, "b": w1, "raw": n0 + n1}
        levels.append(out)
        is_open = (n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * least) & (level < depth)
        ids = np.flatnonzero(is_open)
        if not len(ids):
            break
        keep = is_open[node]
        base, copies, y, node = base[keep], copies[keep], y[keep], (np.cumsum(is_open) - 1)[node[keep]]
        n0, n1, w0, w1 = n0[ids], n1[ids], w0[ids], w1[ids]
        best, feature, cut, l0, l1 = _class_splits(flat, base, node, copies, y, n0, n1, cw, _subsets(rng, len(ids), d, k),
                                                   d, least)
        gain = (best - (w0 * w0 + w1 * w1) / (w0 + w1)) / (w0 + w1)
        ok = gain > 1e-15
        at = ids[ok]
        if not len(at):
            break
        out["left"][at] = next_id + 2 * np.arange(len(at))
        out["feature"][at], out["cut"][at], out["gain"][at] = feature[ok], cut[ok], gain[ok]
        keep = ok[node]
        base, copies, y, node = base[keep], copies[keep], y[keep], node[keep]
        right = flat.take(base + feature[node]) > cut[node]
        node = 2 * (np.cumsum(ok) - 1)[node] + right
        n0, n1 = (np.stack([a[ok], n[ok] - a[ok]], 1).reshape(-1) for a, n in ((l0, n0), (l1, n1)))
        next_id += len(n0)
    return _tree(levels)


def grow_numbers(columns, target, rng, k, least, depth) -> dict:
    """A variance tree; ``columns``: bins of the sampled rows, a feature a row."""
    d, node, m = len(columns), np.zeros(len(target), np.int64), 1
    levels, next_id = [], 1
    for level in range(depth + 1):
        # rows of nodes that are closed have the number m
        n = np.bincount(node, minlength=m + 1)[:m].astype(np.float64)
        s, q = (np.bincount(node, v, m + 1)[:m] for v in (target, target * target))
        variance = q / n - (s / n) ** 2
        out = {"left": np.full(m, -1, np.int64), "feature": np.full(m, -1, np.int64), "cut": np.zeros(m, np.int64),
               "gain": np.full(m, -1.0), "prediction": s / n, "a": s, "b": q, "raw": n}
        levels.append(out)
        if level == depth:
            break
        chosen, at = _subsets(rng, m, d, k), np.arange(m)
        best, feature, cut = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64)
        shifted = node * BINS
        for f in range(d):
            key = shifted + columns[f]
            c = np.bincount(key, minlength=(m + 1) * BINS)[:m * BINS].reshape(m, BINS).cumsum(1)[:, :-1]
            t = np.bincount(key, target, (m + 1) * BINS)[:m * BINS].reshape(m, BINS).cumsum(1)[:, :-1]
            rest = n[:, None] - c
            ok = (c >= least) & (rest >= least)
            if chosen is not None:
                ok &= (chosen == f).any(1)[:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(ok, t * t / c + (s[:, None] - t) ** 2 / rest, -np.inf)
            j = score.argmax(1)
            up = score[at, j] > best
            best[up], feature[up], cut[up] = score[at, j][up], f, j[up]
        gain = (best - s * s / n) / n
        ok = (gain > 1e-15) & (variance > 1e-15)
        if not ok.any():
            break
        out["left"][ok] = next_id + 2 * np.arange(ok.sum())
        out["feature"][ok], out["cut"][ok], out["gain"][ok] = feature[ok], cut[ok], gain[ok]
        new, to = 2 * int(ok.sum()), np.full(m + 1, -1)
        to[:m][ok] = 2 * np.arange(ok.sum())
        b = columns[np.append(feature, 0)[node], np.arange(len(node))]
        first = to[node]
        node = np.where(first < 0, new, first + (b > np.append(cut, 0)[node]))
        m = new
        next_id += new
    return _tree(levels)


def leaves(bins: np.ndarray, t: dict) -> np.ndarray:
    """The leaf of every row."""
    at, d, flat = np.zeros(len(bins), np.int64), bins.shape[1], bins.reshape(-1)
    rows = np.arange(len(bins))
    while len(rows):
        rows = rows[t["left"][at[rows]] >= 0]
        now = at[rows]
        at[rows] = t["left"][now] + (flat.take(rows * d + t["feature"][now]) > t["cut"][now])
    return at


def forest(bins, y, weights, how: dict, trees: range):
    """The trees of a forest with the numbers ``trees``."""
    cw = weights if how["weighted"] else np.ones(2)
    k = features_of_node(how["features"], bins.shape[1], True)
    for i in trees:
        rng = np.random.default_rng([abs(how["seed"]), i])
        copies = np.minimum(rng.poisson(1.0, len(y)), MOST_COPIES) if how["bootstrap"] else np.ones(len(y), np.int64)
        yield grow_classes(bins, y, copies, cw, rng, k, how["least"], how["depth"])


def boosted(bins, y, how: dict, held=None):
    """The trees of a boosted fit with their weights; ``held`` (bins): adds up the margins of these rows."""
    columns, sign = np.ascontiguousarray(bins.T), 2.0 * y - 1.0
    k = features_of_node(how["features"], bins.shape[1], False)
    margin, other = np.zeros(len(y)), None if held is None else np.zeros(len(held))
    for i in range(how["trees"]):
        rng = np.random.default_rng([abs(how["seed"]), i])
        target = sign if i == 0 else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
        taken = np.flatnonzero(rng.random(len(y)) < how["sample"]) if how["sample"] < 1.0 else None
        if taken is not None and len(taken):
            t = grow_numbers(columns[:, taken], target[taken], rng, k, how["least"], how["depth"])
        else:
            t = grow_numbers(columns, target, rng, k, how["least"], how["depth"])
        weight = 1.0 if i == 0 else how["rate"]
        margin += weight * t["prediction"][leaves(bins, t)]
        if held is not None:
            other += weight * t["prediction"][leaves(held, t)]
        yield t, weight, other


# ---- rows of a split in one row -----------------------------------------------------

PACKED = "split int, bins binary, y binary, held binary, ids binary, weights array<double>, cuts array<array<double>>, d int"


def _bytes_of(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _pack(t: pa.Table) -> pa.Table:
    t = t.sort_by([("id", "ascending"), ("k", "ascending"), ("label", "ascending")]).combine_chunks()
    x = t["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
    held = t["held"].to_numpy(zero_copy_only=False).astype(bool)
    label, weight = t["label"].to_numpy()[~held], t["weight"].to_numpy()[~held]
    if not np.isin(label, (0.0, 1.0)).all():
        raise ValueError("training labels must be 0 or 1")
    own, y = x[~held], label.astype(np.uint8)
    weights = [float(weight[y == c][0]) if (y == c).any() else 1.0 for c in (0, 1)]
    if (weight != np.array(weights)[y]).any():
        raise ValueError("weights must be those of the classes")
    each = weight if t["weighted"][0].as_py() else np.ones(len(y))
    cuts = [split_points(own[:, f], each) for f in range(x.shape[1])]
    ids = t.select(["id", "label"]).filter(pa.array(held))
    return pa.table({"split": pa.array([t["split"][0].as_py()], pa.int32()), "bins": pa.array([binned(own, cuts).tobytes()], pa.binary()),
                     "y": pa.array([y.tobytes()], pa.binary()), "held": pa.array([binned(x[held], cuts).tobytes()], pa.binary()),
                     "ids": pa.array([_bytes_of(ids)], pa.binary()), "weights": pa.array([weights], pa.list_(pa.float64())),
                     "cuts": pa.array([[c.tolist() for c in cuts]], pa.list_(pa.list_(pa.float64()))),
                     "d": pa.array([x.shape[1]], pa.int32())})


def _packed(splits: list, id_col: str, vector: str, weighted: bool) -> DataFrame:
    """One row a split, by its position in ``splits``; bins of equal weight or of equal numbers of rows."""
    rows = None
    for i, s in enumerate(splits):
        x = vector_to_array(vector)
        one = s.rows.select(F.lit(i).alias("split"), F.col(id_col).alias("id"), "label", F.coalesce("weight", F.lit(1.0)).alias("weight"),
                            "held", x.alias("x"), F.xxhash64(x).alias("k"), F.lit(weighted).alias("weighted"))
        rows = one if rows is None else rows.unionByName(one)
    spark = rows.sparkSession
    path = shared_table_path(spark, f"packed/{uuid.uuid4().hex}")
    rows.groupBy("split").applyInArrow(_pack, PACKED).write.parquet(path)
    return spark.read.parquet(path)


def width(rows: DataFrame, vector: str) -> int:
    """Slots of a stored vector; 0 without rows."""
    known = rows.schema[vector].metadata.get("ml_attr", {}).get("num_attrs")
    if known:
        return known
    first = rows.select(F.size(vector_to_array(vector)).alias("n")).first()
    return first["n"] if first else 0


def fits(split, stages: list) -> bool:
    """Whether the stages are one tree estimator that is grown here, over rows that fit in a task."""
    how = spec(stages[0]) if len(stages) == 1 else None
    return how is not None and 0 < split.n_train * width(split.rows, how["vector"]) <= TASK_CELLS


def _unpacked(row: dict):
    d = row["d"]
    return (np.frombuffer(row["bins"], np.uint8).reshape(-1, d), np.frombuffer(row["y"], np.uint8).astype(np.int64),
            np.frombuffer(row["held"], np.uint8).reshape(-1, d), np.array(row["weights"]))


def _tasks(packed: dict, splits: list, jobs: list[tuple]) -> DataFrame:
    """Packed rows with the trees to grow: (job, chunk, lo, hi, how), one a task, long ones first.
    ``jobs``: (split, how); ``packed``: {(vector, weighted): rows}."""
    spark = next(iter(packed.values())).sparkSession
    rows = {which: [] for which in packed}
    for job, (split, how) in enumerate(jobs):
        trees, step = how["trees"], how["trees"]
        if how["kind"] == "forest":
            d = width(splits[split].rows, how["vector"])
            work = max(1, splits[split].n_train * features_of_node(how["features"], d, True))
            step = int(min(max(TASK_WORK // work, TREES_PER_TASK[0]), TREES_PER_TASK[1]))
        for chunk, lo in enumerate(range(0, trees, step)):
            rows[how["vector"], how["weighted"]].append((split, job, chunk, lo, min(trees, lo + step), json.dumps(how)))
    out = None
    for which, some in rows.items():
        t = spark.createDataFrame(some, "split int, job int, chunk int, lo int, hi int, how string")
        one = packed[which].join(F.broadcast(t), "split")
        out = one if out is None else out.unionByName(one)
    return out.repartition(max(1, 2 * sum(map(len, rows.values()))), "job", "chunk")


def _held_sums(batches):
    """(job, chunk, trees, sums): margins of boosted trees or summed probabilities of a forest's trees, of the held rows."""
    for batch in batches:
        for row in batch.to_pylist():
            how = json.loads(row["how"])
            bins, y, held, weights = _unpacked(row)
            sums = np.zeros(len(held))
            if how["kind"] == "forest":
                for t in forest(bins, y, weights, how, range(row["lo"], row["hi"])):
                    sums += (t["b"] / (t["a"] + t["b"]))[leaves(held, t)]
            else:
                for _, _, sums in boosted(bins, y, how, held):
                    pass
            first = row["chunk"] == 0
            yield pa.RecordBatch.from_pydict({
                "job": pa.array([row["job"]], pa.int32()), "chunk": pa.array([row["chunk"]], pa.int32()),
                "how": pa.array([row["how"]]), "sums": pa.array([sums.tobytes()], pa.binary()),
                "ids": pa.array([row["ids"] if first else None], pa.binary())})


def _probabilities(id_type: pa.DataType):
    def run(t: pa.Table) -> pa.Table:
        parts = sorted(t.to_pylist(), key=lambda r: r["chunk"])
        how = json.loads(parts[0]["how"])
        total = np.sum([np.frombuffer(r["sums"]) for r in parts], 0)
        p = total / how["trees"] if how["kind"] == "forest" else 1.0 / (1.0 + np.exp(-2.0 * total))
        ids = pa.ipc.open_stream(parts[0]["ids"]).read_all()
        return pa.table({"job": pa.array(np.full(len(p), parts[0]["job"], np.int32)), "id": ids["id"].cast(id_type),
                         "y": ids["label"].cast(pa.int32()), "p": pa.array(p)})
    return run


def held_scores(splits: list, jobs: list[tuple], id_col: str) -> DataFrame:
    """(job, id, y, p) of the held rows; ``jobs``: (split's position, how), grown side by side."""
    from pyspark.sql.pandas.types import to_arrow_type
    packed = {which: _packed(splits, id_col, *which) for which in {(h["vector"], h["weighted"]) for _, h in jobs}}
    field = splits[0].rows.schema[id_col].dataType
    sums = _tasks(packed, splits, jobs).mapInArrow(_held_sums, "job int, chunk int, how string, sums binary, ids binary")
    path = shared_table_path(sums.sparkSession, f"held_sums/{uuid.uuid4().hex}")
    sums.write.parquet(path)
    return sums.sparkSession.read.parquet(path).groupBy("job").applyInArrow(
        _probabilities(to_arrow_type(field)), f"job int, id {field.simpleString()}, y int, p double")


# ---- fitted models in Spark's format --------------------------------------------------

def _node_rows(batches):
    """(treeID, weight, nodeData) of the trees."""
    for batch in batches:
        for row in batch.to_pylist():
            how = json.loads(row["how"])
            bins, y, _, weights = _unpacked(row)
            cuts = [np.array(c) for c in row["cuts"]]
            grown = ((t, 1.0) for t in forest(bins, y, weights, how, range(row["lo"], row["hi"]))) if how["kind"] == "forest" \
                else ((t, w) for t, w, _ in boosted(bins, y, how))
            for i, (t, weight) in enumerate(grown, row["lo"]):
                yield _as_nodes(t, i, weight, cuts, how["kind"] == "forest")


def _as_nodes(t: dict, tree: int, weight: float, cuts: list, classes: bool) -> pa.RecordBatch:
    n, inner = len(t["left"]), t["left"] >= 0
    if classes:
        stats = np.stack([t["a"], t["b"]], 1)
        share = stats / stats.sum(1, keepdims=True)
        impurity = 1.0 - (share * share).sum(1)
    else:
        stats = np.stack([t["raw"], t["a"], t["b"]], 1)
        impurity = t["b"] / t["raw"] - (t["a"] / t["raw"]) ** 2
    threshold = np.array([cuts[f][c] for f, c in zip(t["feature"][inner], t["cut"][inner])], np.float64)
    ends = np.r_[0, np.cumsum(inner)].astype(np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, t["feature"], -1).astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(threshold)),
         pa.array(np.full(n, -1, np.int32))], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = pa.StructArray.from_arrays(
        [pa.array(np.arange(n, dtype=np.int32)), pa.array(t["prediction"]), pa.array(impurity),
         pa.ListArray.from_arrays((np.arange(n + 1) * stats.shape[1]).astype(np.int32), pa.array(stats.reshape(-1))),
         pa.array(t["raw"].astype(np.int64)), pa.array(np.where(inner, t["gain"], -1.0)),
         pa.array(np.where(inner, t["left"], -1).astype(np.int32)), pa.array(np.where(inner, t["left"] + 1, -1).astype(np.int32)),
         split], names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, tree, np.int32)), pa.array(np.full(n, weight)), node],
                                      names=["treeID", "weight", "nodeData"])


def fit(split, stage):
    """The Spark model of a tree estimator, grown over the split's training rows."""
    how, spark = spec(stage), split.rows.sparkSession
    packed = {(how["vector"], how["weighted"]): _packed([split], split.rows.columns[0], how["vector"], how["weighted"])}
    path = shared_table_path(spark, f"grown/{uuid.uuid4().hex}")
    tasks = _tasks(packed, [split], [(0, how)])
    tasks.mapInArrow(_node_rows, f"treeID int, weight double, nodeData {NODE}").select("treeID", "nodeData").write.parquet(f"{path}/data")
    is_forest = how["kind"] == "forest"
    kind = RandomForestClassificationModel if is_forest else GBTClassificationModel
    meta = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = meta | {"class": f"org.apache.spark.ml.classification.{kind.__name__}", "uid": stage.uid,
                    "paramMap": {p.name: v for p, v in stage._paramMap.items()},
                    "defaultParamMap": {p.name: v for p, v in stage._defaultParamMap.items()},
                    "numFeatures": width(split.rows, how["vector"]), "numTrees": how["trees"]}
    whole |= {"numClasses": 2} if is_forest else {}
    one = meta | {"class": "org.apache.spark.ml." + ("classification.DecisionTreeClassificationModel" if is_forest
                                                     else "regression.DecisionTreeRegressionModel"),
                  "paramMap": {"featuresCol": how["vector"], "maxDepth": how["depth"]}, "defaultParamMap": {}}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    weights = [1.0 if is_forest or i == 0 else how["rate"] for i in range(how["trees"])]
    spark.createDataFrame([(i, json.dumps(one | {"uid": f"tree_{uuid.uuid4().hex[:12]}"}), w) for i, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    return kind.load(path)
