"""The v1 model build: repeated cross-validation of all families, out-of-fold
scores, champion and challenger, holdout evaluation.

Preprocessing is fitted once per (repeat, fold) and stored (``ml/prepared``); every
family is fitted on each of them.  The benchmark, the champion and the fairness
audit use all rows in repeated stratified folds; ``holdout_eval`` fits on
development rows only and scores the test rows once.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import split as sp
from ..plans.fixtures import applications_v1
from ..session import materialize
from . import prepared as pp
from .candidates import CHALLENGER, FAMILIES, TREE_FAMILIES, estimators
from .preprocess import v1_stages

FOLDS, REPEATS, SPLIT_SEED, FOLD_SEED, TEST_SIZE = 5, 5, 2026, 42, 0.2
ID = "application_id"


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 rows with label and dev/test split."""
    a = applications_v1(spark, sf_dir).withColumn("label", (F.trim(F.col("loan_status")) == "Y").cast("double"))
    s = sp.stratified_split(a.select(ID, "label"), ID, "label", TEST_SIZE, SPLIT_SEED)
    return a.join(s.select(ID, "split"), ID)


def with_folds(train: DataFrame, repeats: int = REPEATS, folds: int = FOLDS) -> DataFrame:
    """``fold_<r>`` of every repeat."""
    f = sp.repeated_folds(train.select(ID, "label"), ID, "label", folds, repeats, FOLD_SEED)
    wide = f.groupBy(ID).agg(*[F.max(F.when(F.col("repeat") == r, F.col("fold"))).alias(f"fold_{r}") for r in range(repeats)])
    return train.join(wide, ID)


def prepared_folds(train: DataFrame, repeats: int = REPEATS, folds: int = FOLDS) -> dict:
    """{(repeat, fold): Prepared}"""
    rows = materialize(with_folds(train, repeats, folds), "v1_folds", (uuid.uuid4().hex,))
    return pp.prepare_folds(rows, v1_stages, {(r, k): F.col(f"fold_{r}") == k for r in range(repeats)
                                              for k in range(folds)}, ID)


def held_scores(train: DataFrame, families=FAMILIES, repeats: int = REPEATS, folds: int = FOLDS) -> DataFrame:
    """(application_id, model, repeat, fold, y, p) of every family at its own size."""
    return pp.held_scores(prepared_folds(train, repeats, folds), {f: (f, None) for f in families}, estimators, ID)


def benchmark(scores: DataFrame) -> DataFrame:
    """Mean and population std over all folds of accuracy, balanced accuracy,
    AUC, F1, recall(1), recall(0)."""
    by = ["model", "repeat", "fold"]
    fm = ev.classification_metrics(scores, "y", "p", 0.5, by).join(ev.auc(scores, "y", "p", by), by)
    return ev.mean_std_over_folds(fm, ["model"], ["accuracy", "balanced_accuracy", "auc", "f1", "recall", "recall_0"])


def champion(bench: DataFrame) -> str:
    """The tree family with the best (AUC, balanced accuracy); ties: the smaller name."""
    order = (F.col("auc_mean").desc(), F.col("balanced_accuracy_mean").desc(), "model")
    return bench.where(F.col("model").isin(TREE_FAMILIES)).orderBy(*order).first()["model"]


def fit_pair(train: DataFrame, name: str) -> tuple[PipelineModel, dict[str, PipelineModel]]:
    """Preprocessing, and champion and challenger, fitted on all rows."""
    split = pp.prepare(train, v1_stages(), F.lit(False), ID)
    return split.model, pp.fit_all(split, {f: (f, None) for f in FAMILIES}, [name, CHALLENGER], estimators)


def holdout_scores(train: DataFrame, family: str) -> DataFrame:
    """(application_id, y, p) of the test rows, by a fit on the development rows."""
    split = pp.prepare(train, v1_stages(), F.col("split") == "test", ID)
    model = pp.fit_all(split, {family: (family, None)}, [family], estimators)[family]
    scored = model.transform(split.held())
    return scored.select(ID, F.col("label").cast("int").alias("y"), pp.p1(scored).alias("p"))


def holdout_metrics(scores: DataFrame, name: str) -> DataFrame:
    m = ev.classification_metrics(scores, "y", "p", 0.5)
    return m.crossJoin(ev.auc(scores, "y", "p")).crossJoin(ev.brier(scores, "y", "p")) \
            .select(F.lit(name).alias("model"), "*")
