"""Candidate model families of the v1 layout on Spark ML.

Families without a Spark twin are replaced by named stand-ins: the second booster
-> ``GBTClassifier`` in its depth and sampling; the kernel SVM -> random Fourier
features, linear SVC and Platt scaling.  An estimator reads ``scaled`` (linear
models) or ``plain`` vectors.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier

from .rff import RandomFourierFeatures

SEED = 42
UNLIMITED_DEPTH = 30                 # the deepest tree that Spark grows
CHECKPOINT_EVERY = 25                # boosting rounds
# Deep trees: each row keeps its node of every tree, so that a level sends its open nodes only and no
# row walks down all trees again; the trees are the same.
CACHE_NODES = True

# Family sizes and parameters.
LR_C, LR_ITERATIONS = 1.0, 3000
FOREST_TREES, FOREST_LEAF = 500, 3
BOOST_ROUNDS, BOOST_RATE, BOOST_DEPTH = 150, 0.03, 2
SECOND_ROUNDS, SECOND_RATE, SECOND_DEPTH, SECOND_SAMPLE = 300, 0.03, 3, 0.9
SVM_C, SVM_FEATURES, SVM_ITERATIONS = 1.5, 100, 50

FAMILIES = ["logistic_regression", "random_forest", "gradient_boosting", "rbf_svm_standin", "second_boosting"]
TREE_FAMILIES = ["random_forest", "gradient_boosting", "second_boosting"]     # the champion is one of them
CHALLENGER = "logistic_regression"


def logistic(rows: int, c: float = LR_C, iterations: int = LR_ITERATIONS) -> LogisticRegression:
    """C over n rows is a penalty of 1 / (C n) per row."""
    return LogisticRegression(featuresCol="scaled", regParam=1.0 / (c * rows), elasticNetParam=0.0,
                              maxIter=iterations, standardization=False)


def boosting(rounds: int, rate: float, depth: int, **params) -> GBTClassifier:
    return GBTClassifier(featuresCol="plain", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=SEED,
                         checkpointInterval=CHECKPOINT_EVERY, **params)


def estimators(family: str, params: dict | None, rows: int) -> list:
    """The stages after preprocessing; ``rows``: number of training rows."""
    p = dict(params or {})
    if family == "logistic_regression":
        return [logistic(rows, p.get("C", LR_C))]
    if family == "random_forest":
        return [RandomForestClassifier(
            featuresCol="plain", numTrees=p.get("numTrees", FOREST_TREES), maxDepth=p.get("maxDepth", UNLIMITED_DEPTH),
            minInstancesPerNode=p.get("minInstancesPerNode", FOREST_LEAF), featureSubsetStrategy="sqrt",
            weightCol="weight", maxMemoryInMB=512, cacheNodeIds=CACHE_NODES, seed=SEED)]
    if family == "gradient_boosting":
        return [boosting(p.get("maxIter", BOOST_ROUNDS), p.get("stepSize", BOOST_RATE), p.get("maxDepth", BOOST_DEPTH))]
    if family == "second_boosting":
        return [boosting(p.get("maxIter", SECOND_ROUNDS), p.get("stepSize", SECOND_RATE), p.get("maxDepth", SECOND_DEPTH),
                         subsamplingRate=SECOND_SAMPLE, featureSubsetStrategy=str(SECOND_SAMPLE))]
    if family == "rbf_svm_standin":
        return [RandomFourierFeatures(inputCol="scaled", outputCol="rff", numFeatures=SVM_FEATURES, seed=SEED),
                LinearSVC(featuresCol="rff", regParam=1.0 / (SVM_C * rows), maxIter=SVM_ITERATIONS, weightCol="weight",
                          rawPredictionCol="svm_raw", predictionCol="svm_pred"),
                # Platt scaling on the raw margin vector (-m, m); a tiny ridge term settles the collinear pair
                LogisticRegression(featuresCol="svm_raw", rawPredictionCol="platt_raw", regParam=1e-4, maxIter=50)]
    raise ValueError(f"unknown model family: {family}")
