"""Prepared vectors: preprocessing is fitted once per data split and its output
stored, so that every family, trial and fold fit reads small vectors instead of
running feature engineering, imputation and encoding again.

A split has training rows and held rows.  Its preprocessing sees the training rows
only; both are transformed and written once under the shared folder (id, label,
weight, held, plain, scaled).  Fits on splits are independent Spark jobs, run side
by side from a bounded pool of driver threads; their scores are written by each
job, so a finished fit is never repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..session import shared_table_path
from . import grown

PARALLEL_FITS = 8
ROWS_PER_PARTITION = 50_000       # of prepared rows: an iterative fit runs hundreds of jobs over them


@dataclass
class Prepared:
    """Preprocessing fitted on the rows that are not held, and the vectors of all rows."""
    model: PipelineModel
    rows: DataFrame
    n_train: int

    def train(self) -> DataFrame:
        return self.rows.where("NOT held")

    def held(self) -> DataFrame:
        return self.rows.where("held")


def in_parallel(jobs: list[Callable]) -> list:
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(lambda job: job(), jobs))


def prepare(rows: DataFrame, stages: list, held: Column, id_col: str) -> Prepared:
    """``rows`` (id, label, raw columns) split by ``held``, prepared by ``stages``.
    Weights balance the classes of the training rows."""
    spark = rows.sparkSession
    train = rows.where(~held)
    model = Pipeline(stages=stages).fit(train)
    w = {r["label"]: r["weight"] for r in ev.class_weights(train, "label").collect()}        # one row a class
    weight = F.coalesce(*[F.when(F.col("label") == k, F.lit(v)) for k, v in w.items()], F.lit(1.0))
    path = shared_table_path(spark, f"prepared/{uuid.uuid4().hex}")
    dealt = rows.repartition(max(1, -(-rows.count() // ROWS_PER_PARTITION)))       # raw rows: a fraction of their vectors
    model.transform(dealt).select(id_col, "label", weight.alias("weight"), held.alias("held"), "plain", "scaled") \
         .write.parquet(path)
    stored = spark.read.parquet(path)
    return Prepared(model, stored, stored.where("NOT held").count())


def prepare_folds(rows: DataFrame, stages: Callable[[], list], folds: dict, id_col: str) -> dict:
    """``folds`` {key: held condition} -> {key: Prepared}; the splits are prepared side by side."""
    keys = list(folds)
    done = in_parallel([(lambda k: lambda: prepare(rows, stages(), folds[k], id_col))(k) for k in keys])
    return dict(zip(keys, done))


def p1(df: DataFrame, probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability)).getItem(1)


def fit(split: Prepared, estimators: list) -> PipelineModel:
    return Pipeline(stages=estimators).fit(split.train())


def held_scores(splits: dict, candidates: dict, estimators: Callable, id_col: str) -> DataFrame:
    """(id, model, repeat, fold, y, p): the held rows of every split {(repeat, fold): Prepared},
    scored by every candidate {name: (family, params)} fitted on its training rows.  Trees over
    rows that fit in a task are grown side by side (``grown``)."""
    spark = next(iter(splits.values())).rows.sparkSession
    out = shared_table_path(spark, f"held_scores/{uuid.uuid4().hex}")
    for s in splits.values():
        s.rows.persist()

    def job(name, stages, repeat, fold):
        def run():
            split = splits[repeat, fold]
            model = fit(split, stages)
            scored = model.transform(split.held())
            (scored.select(id_col, F.lit(name).alias("model"), F.lit(repeat).alias("repeat"), F.lit(fold).alias("fold"),
                           F.col("label").cast("int").alias("y"), p1(scored).alias("p"))
             .write.parquet(f"{out}/{uuid.uuid4().hex}"))
        return run

    jobs, trees = [], []
    for at, k in enumerate(splits):
        for n, (fam, params) in candidates.items():
            stages = estimators(fam, params, splits[k].n_train)
            if grown.fits(splits[k], stages):
                trees.append(((n, *k), (at, grown.spec(stages[0]))))
            else:
                jobs.append(job(n, stages, *k))
    try:
        in_parallel(jobs)
        if trees:
            of = spark.createDataFrame([(i, *key) for i, (key, _) in enumerate(trees)], "job int, model string, repeat int, fold int")
            scored = grown.held_scores(list(splits.values()), [how for _, how in trees], id_col)
            (scored.join(F.broadcast(of), "job").select(F.col("id").alias(id_col), "model", "repeat", "fold", "y", "p")
             .write.parquet(f"{out}/{uuid.uuid4().hex}"))
    finally:
        for s in splits.values():
            s.rows.unpersist()
    return spark.read.parquet(f"{out}/*")


def vector_read(estimators: list) -> str:
    """The prepared vector that the first of the stages reads."""
    first = estimators[0]
    return first.getOrDefault("featuresCol" if first.hasParam("featuresCol") else "inputCol")


# Spark's own fits pack the rows into blocks or binned points, which they keep while they run.
PACKING = (LogisticRegression, LinearSVC, RandomForestClassifier, GBTClassifier)


def fit_all(split: Prepared, candidates: dict, names: list[str], estimators: Callable) -> dict[str, PipelineModel]:
    """{name: estimator stages fitted on the split's training rows}.  Trees over rows that fit in a task are
    grown there (``grown``); fits that pack the rows read the stored table; for others these rows and the
    vectors that are read are kept in memory."""
    stages = {n: estimators(*candidates[n], split.n_train) for n in names}
    train = split.train().select("label", "weight", *sorted({vector_read(s) for s in stages.values()}))
    kept = any(type(s[-1]) not in PACKING for s in stages.values())
    if kept:
        train = train.persist()

    def job(stages):
        return lambda: (PipelineModel([grown.fit(split, stages[0])]) if grown.fits(split, stages) else Pipeline(stages=stages).fit(train))

    try:
        return dict(zip(names, in_parallel([job(stages[n]) for n in names])))
    finally:
        if kept:
            train.unpersist()


def score(rows: DataFrame, model: PipelineModel, members: dict[str, PipelineModel]) -> DataFrame:
    """``rows`` (raw) with ``p_<name>`` of every member: the preprocessing runs once, the
    members read its vectors one after the other in the same projection, without a join."""
    keep = rows.columns
    x = model.transform(rows)
    inputs = x.columns
    done: list[str] = []
    for name, member in members.items():
        x = member.transform(x)
        done.append(f"p_{name}")
        x = x.select(*inputs, *done[:-1], p1(x).alias(done[-1]))
    return x.select(*keep, *done)
