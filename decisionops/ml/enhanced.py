"""The v2 model build: candidate families, tuning, out-of-fold scores, finalists,
blend, holdout evaluation, and the bundle that scores new rows.

Selection (benchmark, tuning, finalists, blend, threshold) sees development
rows only; the holdout is scored once, by the fitted members of the blend.
Untuned candidates and all trials are fitted on the same prepared folds
(``ml/prepared``), side by side; the best trial's out-of-fold scores are the
tuned candidate's.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blend as bl
from ..operators import clean as cl
from ..operators import evaluate as ev
from ..operators import split as sp
from ..plans.fixtures import V2_PREDICTORS, applications_v2_raw
from ..session import materialize
from . import prepared as pp
from .candidates import CACHE_NODES, UNLIMITED_DEPTH, boosting, logistic
from .preprocess import v2_stages

SEED, TEST_SIZE, FINALISTS = 42, 0.2, 4
ID = "loan_id"
FOLDS = {"fast": 3, "balanced": 5, "max": 5}
TRIALS = {"fast": 3, "balanced": 12, "max": 50}
REPEATS = {"fast": 3, "balanced": 8, "max": 12}

# Ensemble sizes by mode, and the parameters of the untuned candidates.
TREES = {"fast": 120, "balanced": 350, "max": 700}
BOOSTS = {"fast": 120, "balanced": 300, "max": 500}
LR_ITERATIONS = 4000
FOREST = {"max_depth": None, "min_samples_leaf": 2, "min_samples_split": 2, "max_features": "sqrt", "class_weight": None}
EXTRA = {"max_depth": None, "min_samples_leaf": 1, "min_samples_split": 2, "max_features": 0.8, "class_weight": None}
DEPTHWISE = {"max_depth": 3, "learning_rate": 0.04, "min_child_weight": 2, "subsample": 0.9, "colsample_bytree": 0.9}
LEAFWISE = {"num_leaves": 15, "max_depth": 5, "learning_rate": 0.04, "min_child_samples": 20, "subsample": 0.9,
            "colsample_bytree": 0.9}

# Tuning ranges.  (low, high, step) by mode, choices, (low, high) of whole numbers,
# of reals, and of reals on a log scale.
TUNED_TREES = {"fast": (120, 320, 100), "balanced": (300, 900, 150), "max": (500, 1400, 150)}
TUNED_BOOSTS = {"fast": (100, 300, 100), "balanced": (250, 700, 100), "max": (300, 1000, 100)}
RANGES = {
    "extra_trees_standin": {
        "n_estimators": ("steps", TUNED_TREES), "max_depth": ("one of", [None, 6, 8, 10, 14, 18]),
        "min_samples_leaf": ("whole", 1, 4), "min_samples_split": ("whole", 2, 8),
        "max_features": ("one of", ["sqrt", 0.7, 0.9, 1.0]), "class_weight": ("one of", [None, "balanced"])},
    "random_forest": {
        "n_estimators": ("steps", TUNED_TREES), "max_depth": ("one of", [None, 5, 7, 9, 12, 16]),
        "min_samples_leaf": ("whole", 1, 5), "min_samples_split": ("whole", 2, 10),
        "max_features": ("one of", ["sqrt", 0.6, 0.8, 1.0]), "class_weight": ("one of", [None, "balanced"])},
    "boosted_depthwise": {
        "n_estimators": ("steps", TUNED_BOOSTS), "max_depth": ("whole", 2, 6), "learning_rate": ("log", 0.015, 0.12),
        "min_child_weight": ("real", 1, 8), "subsample": ("real", 0.7, 1.0), "colsample_bytree": ("real", 0.65, 1.0)},
    "boosted_leafwise": {
        "n_estimators": ("steps", TUNED_BOOSTS), "learning_rate": ("log", 0.015, 0.12), "num_leaves": ("whole", 7, 48),
        "max_depth": ("whole", 3, 9), "min_child_samples": ("whole", 10, 60), "subsample": ("real", 0.7, 1.0),
        "colsample_bytree": ("real", 0.65, 1.0)},
}

# Spark ML twins and stand-ins: extra trees -> a forest without bootstrap on a share of the
# features; the boosted-tree libraries -> GBTClassifier in the depth and sampling of each.
FAMILIES = ["logistic_regression", *RANGES]
TUNED = list(RANGES)


def estimators(quality: str = "fast"):
    """(family, params, rows) -> stages after preprocessing, with the mode's sizes."""
    def build(family: str, params: dict | None, rows: int) -> list:
        p = dict(params or {})
        if family == "logistic_regression":
            return [logistic(rows, p.get("C", 1.0), LR_ITERATIONS)]
        if family in ("random_forest", "extra_trees_standin"):
            p = {"n_estimators": TREES[quality], **(FOREST if family == "random_forest" else EXTRA), **p}
            forest = RandomForestClassifier(
                featuresCol="plain", numTrees=p["n_estimators"], maxDepth=p["max_depth"] or UNLIMITED_DEPTH,
                # a node that may be split has two children of this size: the twin of both minima
                minInstancesPerNode=max(p["min_samples_leaf"], math.ceil(p["min_samples_split"] / 2)),
                bootstrap=family == "random_forest", featureSubsetStrategy=_share(p["max_features"]),
                maxMemoryInMB=512, cacheNodeIds=CACHE_NODES, seed=SEED)
            return [forest.setWeightCol("weight") if p["class_weight"] == "balanced" else forest]
        if family == "boosted_depthwise":
            p = {"n_estimators": BOOSTS[quality], **DEPTHWISE, **p}
            # a child's weight is a sum of p (1 - p), at most a quarter a row
            least, depth = math.ceil(4 * p["min_child_weight"]), p["max_depth"]
        elif family == "boosted_leafwise":
            p = {"n_estimators": BOOSTS[quality], **LEAFWISE, **p}
            least, depth = p["min_child_samples"], min(p["max_depth"], math.ceil(math.log2(p["num_leaves"])))
        else:
            raise ValueError(f"unknown model family: {family}")
        return [boosting(p["n_estimators"], p["learning_rate"], depth, minInstancesPerNode=least,
                         subsamplingRate=p["subsample"], featureSubsetStrategy=_share(p["colsample_bytree"]))]

    return build


def _share(features) -> str:
    return features if isinstance(features, str) else "all" if features == 1.0 else str(round(float(features), 3))


def training_frame(spark: SparkSession, sf_dir: str, quality: str = "fast") -> DataFrame:
    """Cleaned v2 rows: raw predictors, label, split, and fold of development rows."""
    a = cl.clean_v2(applications_v2_raw(spark, sf_dir)).where(F.col("target").isNotNull())
    a = a.select(ID, *V2_PREDICTORS, F.col("target").cast("double").alias("label"))
    s = sp.stratified_split(a.select(ID, "label"), ID, "label", TEST_SIZE, SEED)
    a = a.join(s.select(ID, "split"), ID)
    dev = a.where("split = 'dev'").select(ID, "label")
    f = sp.stratified_folds(dev, ID, "label", FOLDS[quality], SEED)
    return a.join(f.select(ID, "fold"), ID, "left")


def prepared_folds(train: DataFrame, quality: str = "fast") -> dict:
    """{(0, fold): Prepared} over the development rows."""
    dev = train.where("split = 'dev'")
    return pp.prepare_folds(dev, v2_stages, {(0, k): F.col("fold") == k for k in range(FOLDS[quality])}, ID)


def out_of_fold(folds: dict, candidates: dict[str, tuple], quality: str = "fast") -> DataFrame:
    """(loan_id, model, fold, y, p) for candidates {name: (family, params)}."""
    return pp.held_scores(folds, candidates, estimators(quality), ID).drop("repeat")


def benchmark(oof: DataFrame) -> DataFrame:
    """Mean and population std over folds, best first: by accuracy, then AUC."""
    m = ev.classification_metrics(oof, "y", "p", 0.5, ["model", "fold"]).join(
        ev.auc(oof, "y", "p", ["model", "fold"]), ["model", "fold"])
    s = ev.mean_std_over_folds(m, ["model"], ["accuracy", "balanced_accuracy", "auc", "f1"])
    return s.orderBy(F.col("accuracy_mean").desc(), F.col("auc_mean").desc(), "model")


def sample_params(family: str, trials: int, quality: str, seed: int = SEED) -> list[dict]:
    """A seeded random search in the tuning ranges of a family."""
    rng = np.random.default_rng([seed, FAMILIES.index(family)])

    def draw(kind, *of):
        if kind == "steps":
            low, high, step = of[0][quality]
            return int(rng.choice(np.arange(low, high + 1, step)))
        if kind == "one of":
            return of[0][int(rng.integers(len(of[0])))]
        if kind == "whole":
            return int(rng.integers(of[0], of[1] + 1))
        return float(rng.uniform(*of) if kind == "real" else np.exp(rng.uniform(*np.log(of))))

    return [{name: draw(*how) for name, how in RANGES[family].items()} for _ in range(trials)]


def trial_candidates(families=TUNED, quality: str = "fast") -> dict[str, tuple]:
    """{"<family>#<trial>": (family, params)}, all trials of the mode."""
    return {f"{f}#{i}": (f, p) for f in families for i, p in enumerate(sample_params(f, TRIALS[quality], quality))}


def tuning_table(oof: DataFrame, trials: dict[str, tuple]) -> DataFrame:
    """(model, trial, params, cv_accuracy, cv_auc, best): mean fold metrics of every
    trial; a family's best has the highest accuracy (the first on a tie)."""
    spark = oof.sparkSession
    named = spark.createDataFrame([(n, f, int(n.split("#")[1]), json.dumps(p, sort_keys=True))
                                   for n, (f, p) in trials.items()],
                                  "name string, model string, trial int, params string")
    b = benchmark(oof).select(F.col("model").alias("name"), F.col("accuracy_mean").alias("cv_accuracy"),
                              F.col("auc_mean").alias("cv_auc"))
    t = named.join(F.broadcast(b), "name")
    top = t.groupBy("model").agg(F.max_by("trial", F.struct("cv_accuracy", -F.col("trial"))).alias("top"))
    return t.join(F.broadcast(top), "model").select(
        "model", "trial", "params", "cv_accuracy", "cv_auc", (F.col("trial") == F.col("top")).alias("best"))


def with_tuned(tuning: DataFrame | None, families=FAMILIES) -> dict[str, tuple]:
    """Candidates by family; a family's best trial replaces its untuned entry."""
    out = {f: (f, None) for f in families}
    if tuning is not None:
        out.update({r["model"]: (r["model"], json.loads(r["params"])) for r in tuning.where("best").collect()})
    return out


def finalists(oof: DataFrame, most: int = FINALISTS) -> list[str]:
    """The best candidates on all out-of-fold scores: by accuracy, balanced
    accuracy, AUC, then name."""
    m = ev.classification_metrics(oof, "y", "p", 0.5, ["model"]).join(ev.auc(oof, "y", "p", ["model"]), "model")
    order = (F.col("accuracy").desc(), F.col("balanced_accuracy").desc(), F.col("auc").desc(), "model")
    return [r["model"] for r in m.orderBy(*order).limit(most).select("model").collect()]


def blend(oof: DataFrame, names: list[str]) -> DataFrame:
    """Weights and threshold of the finalists, chosen on out-of-fold scores."""
    wide = oof.groupBy(ID, "y").agg(*[F.max(F.when(F.col("model") == n, F.col("p"))).alias(f"p_{n}") for n in names])
    return bl.blend_search(wide, [f"p_{n}" for n in names], "y")


# ---- the bundle -----------------------------------------------------------------

@dataclass
class Bundle:
    """What scoring needs: preprocessing, members in blend order with weights, threshold,
    baselines (feature -> value) and metadata."""
    preprocessing: PipelineModel
    members: dict[str, PipelineModel]
    weights: list[float]
    threshold: float
    baselines: dict
    metadata: dict


def baselines(train: DataFrame) -> dict:
    """Mode or median of every raw predictor over the development rows."""
    categorical = [c for c in V2_PREDICTORS if c in ("education", "self_employed")]
    rows = ev.feature_baselines(train.where("split = 'dev'"), categorical,
                                [c for c in V2_PREDICTORS if c not in categorical]).collect()     # one a predictor
    return {r["feature"]: r["category"] if r["kind"] == "categorical" else r["number"] for r in rows}


def fit_bundle(train: DataFrame, candidates: dict[str, tuple], names: list[str], weights: list[float],
               threshold: float, metadata: dict, quality: str = "fast") -> Bundle:
    """Members fitted on all development rows."""
    split = pp.prepare(train, v2_stages(), F.col("split") == "test", ID)
    members = pp.fit_all(split, candidates, names, estimators(quality))
    return Bundle(split.model, members, [float(w) for w in weights], float(threshold), baselines(train), metadata)


def save_bundle(spark: SparkSession, path: str, bundle: Bundle) -> None:
    """Models as Spark ML artifacts, side tables for the rest."""
    bundle.preprocessing.write().overwrite().save(f"{path}/preprocessing")
    for n, model in bundle.members.items():
        model.write().overwrite().save(f"{path}/models/{n}")
    spark.createDataFrame([(i, n, w) for i, (n, w) in enumerate(zip(bundle.members, bundle.weights))],
                          "position int, model string, weight double").write.mode("overwrite").parquet(f"{path}/members")
    spark.createDataFrame([(f, json.dumps(v)) for f, v in bundle.baselines.items()], "feature string, value string") \
        .write.mode("overwrite").parquet(f"{path}/baselines")
    spark.createDataFrame([(bundle.threshold, json.dumps(bundle.metadata, sort_keys=True))],
                          "threshold double, metadata string").write.mode("overwrite").parquet(f"{path}/info")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    table = sorted(spark.read.parquet(f"{path}/members").collect(), key=lambda r: r["position"])
    info = spark.read.parquet(f"{path}/info").first()
    base = {r["feature"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/baselines").collect()}
    members = {r["model"]: PipelineModel.load(f"{path}/models/{r['model']}") for r in table}
    return Bundle(PipelineModel.load(f"{path}/preprocessing"), members, [r["weight"] for r in table],
                  info["threshold"], base, json.loads(info["metadata"]))


def ensemble_probability(bundle: Bundle) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"p_{n}") for n, w in zip(bundle.members, bundle.weights)])


def ensemble_scores(rows: DataFrame, bundle: Bundle) -> DataFrame:
    """``rows`` (raw predictors and any other columns) with p_<member> and p, the weighted mean."""
    return pp.score(rows, bundle.preprocessing, bundle.members).withColumn("p", ensemble_probability(bundle))


def predictions(rows: DataFrame, bundle: Bundle, scored: DataFrame | None = None) -> DataFrame:
    """loan_id, likely_approved, probabilities, confidence, threshold, ensemble_members
    (model, weight, approval_probability) of raw ``rows``, or of rows that are scored already."""
    p, ok = F.col("p"), F.col("p") >= F.lit(bundle.threshold)
    members = F.array(*[F.struct(F.lit(n).alias("model"), F.round(F.lit(w), 4).alias("weight"),
                                 F.round(F.col(f"p_{n}"), 6).alias("approval_probability"))
                        for n, w in zip(bundle.members, bundle.weights)])
    scored = ensemble_scores(rows, bundle) if scored is None else scored
    return scored.select(
        ID, ok.alias("likely_approved"), F.round(p, 6).alias("approval_probability"),
        F.round(1 - p, 6).alias("rejection_probability"),
        F.round(F.when(ok, p).otherwise(1 - p), 6).alias("confidence"),
        F.lit(bundle.threshold).alias("threshold"), members.alias("ensemble_members"))


BASE = "(none)"


def sensitivity_scores(rows: DataFrame, bundle: Bundle) -> DataFrame:
    """(loan_id, feature, p_<member>..., p): each row as it is (feature ``(none)``) and with one
    raw predictor set to its baseline; the variants of a row are stacked and scored in one pass."""
    def variant(feature: str) -> Column:
        return F.struct(F.lit(feature).alias("feature"), *[
            (F.lit(bundle.baselines[c]).cast(rows.schema[c].dataType) if c == feature else F.col(c)).alias(c)
            for c in V2_PREDICTORS])

    stack = rows.select(ID, F.explode(F.array(*[variant(f) for f in [BASE, *bundle.baselines]])).alias("v"))
    return ensemble_scores(stack.select(ID, "v.*"), bundle).drop(*V2_PREDICTORS)


# Display names of the raw predictors.
LABELS = {"cibil_score": "CIBIL score", "loan_amount": "Loan amount", "income_annum": "Annual income",
          "loan_term": "Loan term", "residential_assets_value": "Residential assets",
          "commercial_assets_value": "Commercial assets", "luxury_assets_value": "Luxury assets",
          "bank_asset_value": "Bank assets", "no_of_dependents": "Dependents", "education": "Education",
          "self_employed": "Self-employment"}


def sensitivity(scores: DataFrame, top: int = 6) -> DataFrame:
    """(loan_id, rank, feature, label, contribution, direction): the predictors whose baseline
    moves the ensemble score most; equal moves by feature name."""
    base = F.max(F.when(F.col("feature") == BASE, F.col("p")))
    moved = F.collect_list(F.when(F.col("feature") != BASE, F.struct("feature", "p")))     # one a predictor
    g = scores.groupBy(ID).agg(base.alias("base"), moved.alias("moved"))
    items = F.transform("moved", lambda m: F.struct(
        (-F.abs(F.round(F.col("base") - m["p"], 6))).alias("k"), m["feature"].alias("feature"),
        (F.round(F.col("base") - m["p"], 6) + F.lit(0.0)).alias("c")))
    label = F.coalesce(*[F.when(F.col("i.feature") == f, F.lit(t)) for f, t in LABELS.items()], F.col("i.feature"))
    return (g.select(ID, F.posexplode(F.slice(F.sort_array(items), 1, top)).alias("pos", "i"))
            .select(ID, (F.col("pos") + 1).cast("long").alias("rank"), "i.feature", label.alias("label"),
                    F.col("i.c").alias("contribution"),
                    F.when(F.col("i.c") >= 0, "supports approval").otherwise("reduces approval").alias("direction")))


def permutation_scores(rows: DataFrame, bundle: Bundle, repeats: int) -> DataFrame:
    """(loan_id, label, feature, repeat, p_<member>..., p) of every row with one raw predictor taken
    from another row, and of the rows as they are (feature ``(none)``, repeat 0).

    The row at position i of one fixed order receives predictor f of repeat r from the row at
    position i in the order of md5(id:f:r).  Only narrow donor rows (one value) are ranked and shuffled; they
    are joined before the fitted models, which see one stack of variants."""
    t = sp.stratified_rank(rows.withColumn("_all", F.lit(1)), ID, "_all", "rows").select(
        ID, "label", *V2_PREDICTORS, F.col("_rank").alias("pos"))
    t = materialize(t, "permutation_rows", (uuid.uuid4().hex,))
    text = {c for c, kind in t.select(*V2_PREDICTORS).dtypes if kind == "string"}
    donors = [F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"),
                       (F.col(f) if f in text else F.lit(None).cast("string")).alias("s"),
                       (F.lit(None).cast("double") if f in text else F.col(f).cast("double")).alias("d"))
              for f in V2_PREDICTORS for r in range(repeats)]
    narrow = t.select(ID, F.explode(F.array(*donors)).alias("e")).select(ID, "e.*").withColumns({
        "_of": F.concat_ws(":", "feature", F.col("repeat").cast("string")),
        "_pid": F.concat_ws(":", F.col(ID).cast("string"), "feature", F.col("repeat").cast("string"))})
    ranked = sp.stratified_rank(narrow, "_pid", "_of", "permute").select(
        "feature", "repeat", "s", "d", F.col("_rank").alias("pos"))
    swapped = ranked.join(t, "pos").select(ID, "label", "feature", "repeat", *[
        F.when(F.col("feature") == c, (F.col("s") if c in text else F.col("d")).cast(t.schema[c].dataType))
        .otherwise(F.col(c)).alias(c) for c in V2_PREDICTORS])
    own = t.select(ID, "label", F.lit(BASE).alias("feature"), F.lit(0).alias("repeat"), *V2_PREDICTORS)
    return ensemble_scores(own.unionByName(swapped), bundle).drop(*V2_PREDICTORS)


def permutation_importance(scores: DataFrame, threshold: float) -> DataFrame:
    """(feature, importance, std): drop in accuracy, mean and population std over repeats."""
    right = F.count_if((F.col("p") >= F.lit(threshold)).cast("double") == F.col("label"))
    acc = scores.groupBy("feature", "repeat").agg((right / F.count(F.lit(1))).alias("acc"))
    base = acc.where(F.col("feature") == BASE).select(F.col("acc").alias("base"))
    drops = acc.where(F.col("feature") != BASE).crossJoin(F.broadcast(base))        # features x repeats rows
    drop = F.col("base") - F.col("acc")
    return (drops.groupBy("feature").agg((F.round(F.avg(drop), 6) + F.lit(0.0)).alias("importance"),
                                         (F.round(F.stddev_pop(drop), 6) + F.lit(0.0)).alias("std"))
            .orderBy(F.col("importance").desc(), "feature"))


def holdout_metrics(scored: DataFrame, names: list[str], threshold: float) -> DataFrame:
    """Metrics of the ensemble at its threshold and, as diagnostics, of every
    member at 0.5.  ``scored``: label, p, p_<member>."""
    y = F.col("label").cast("int").alias("y")
    long = scored.select(y, F.explode(F.array(
        F.struct(F.lit("ensemble").alias("model"), F.col("p").alias("p"), F.lit(threshold).alias("t")),
        *[F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("p"), F.lit(0.5).alias("t")) for n in names])).alias("m")
    ).select("y", "m.*")
    m = ev.confusion_counts(long, "y", (F.col("p") >= F.col("t")).cast("int"), ["model"])
    return m.select("model", "tn", "fp", "fn", "tp", *ev.metric_columns()).join(ev.auc(long, "y", "p", ["model"]), "model")
