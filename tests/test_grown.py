"""Trees grown in tasks against Spark's own fits."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors

from decisionops.ml import candidates, grown
from decisionops.ml import prepared as pp


@pytest.fixture(scope="module")
def split(spark):
    from decisionops.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(size=(500, 4)), rng.integers(0, 2, 500)]
    y = (x[:, 0] + x[:, 1] * x[:, 4] + rng.normal(size=500) > 0.5).astype(float)
    rows = spark.createDataFrame([(i, float(a), 0.8 if a else 1.3, i % 4 == 0, Vectors.dense(v)) for i, (a, v) in enumerate(zip(y, x))],
                                 ["id", "label", "weight", "held", "plain"]).repartition(3).persist()
    yield SimpleNamespace(rows=rows, n_train=375, train=lambda: rows.where("NOT held"), held=lambda: rows.where("held"))
    rows.unpersist()


def _scores(df):
    return [r[1] for r in sorted(df.collect())]


@pytest.mark.parametrize("kind", ["boosting", "forest"])
def test_grown_trees_are_those_of_spark(split, kind):
    """Without draws the models are the same: nodes, scores, importances; held rows are scored in the tasks alike."""
    stage = GBTClassifier(featuresCol="plain", maxIter=8, stepSize=0.2, maxDepth=4, minInstancesPerNode=12, seed=1) \
        if kind == "boosting" else RandomForestClassifier(
            featuresCol="plain", numTrees=2, maxDepth=5, bootstrap=False, featureSubsetStrategy="all", weightCol="weight",
            minInstancesPerNode=12, seed=1)
    mine, spark_own = grown.fit(split, stage), stage.fit(split.train())
    a, b = (m.transform(split.held()) for m in (mine, spark_own))
    a, b = (_scores(df.select("id", pp.p1(df))) for df in (a, b))
    assert len(a) == 125 and np.abs(np.subtract(a, b)).max() < 1e-9 and mine.totalNumNodes == spark_own.totalNumNodes
    assert np.abs(mine.featureImportances.toArray() - spark_own.featureImportances.toArray()).max() < 1e-9
    held = grown.held_scores([split], [(0, grown.spec(stage))], "id")
    assert np.abs(np.subtract(_scores(held.select("id", "p")), a)).max() < 1e-9


def test_grown_forest_draws(split):
    """Draws of rows and features: unlike trees, whatever the partitions, about as good as Spark's forest."""
    stage = candidates.estimators("random_forest", {"numTrees": 70}, 375)[0]
    how = grown.spec(stage)
    one = _scores(grown.held_scores([split], [(0, how)], "id").select("id", "p"))
    moved = SimpleNamespace(rows=split.rows.repartition(5), n_train=375)
    assert one == _scores(grown.held_scores([moved], [(0, how)], "id").select("id", "p"))
    theirs = stage.fit(split.train()).transform(split.held())
    theirs = _scores(theirs.select("id", pp.p1(theirs)))
    assert np.corrcoef(one, theirs)[0, 1] > 0.95 and len(set(one)) > 60


def test_quantile_bins():
    x = np.random.default_rng(1).normal(size=5000)
    cuts = grown.split_points(x, np.ones(5000))
    share = np.diff(np.r_[0, np.searchsorted(np.sort(x), cuts), 5000])
    assert len(cuts) == 31 and share.min() > 150 and share.max() < 163
    assert grown.split_points(np.array([1.0, 3.0, 3.0, 4.0]), np.ones(4)).tolist() == [2.0, 3.5]
    assert not len(grown.split_points(np.ones(3), np.ones(3)))


def test_fold_fits_of_trees_run_in_tasks(split, monkeypatch):
    """No level-by-level fit where the rows fit in a task; Spark's fit where they do not."""
    def refuse(self, rows):
        raise AssertionError("a level-by-level fit")

    kinds = {"random_forest": {"numTrees": 3, "maxDepth": 4}, "gradient_boosting": {"maxIter": 2}}
    names = {n: (n, p) for n, p in kinds.items()}
    with monkeypatch.context() as m:
        for kind in (RandomForestClassifier, GBTClassifier):
            m.setattr(kind, "_fit", refuse, raising=False)
        out = pp.held_scores({(0, 0): split}, names, candidates.estimators, "id").collect()
        assert len(out) == 2 * 125 and all(0 <= r.p <= 1 for r in out)
        assert set(pp.fit_all(split, names, list(names), candidates.estimators)) == set(names)
        m.setattr(grown, "TASK_CELLS", 375)
        with pytest.raises(AssertionError):
            pp.held_scores({(0, 0): split}, names, candidates.estimators, "id")
