"""The registered model builds run whole: every repeat, family size and trial (no fit is made here)."""

from types import SimpleNamespace

import pytest

from decisionops.ml import cv, enhanced
from decisionops.ml import prepared as pp
from decisionops.plans import ml_queries as mq


class Stop(Exception):
    pass


@pytest.fixture
def v1_calls(monkeypatch):
    """What the v1 build asks of the fold fits."""
    calls = {}

    def folds(train, repeats, folds):
        calls.update(repeats=repeats, folds=folds)

    def held(splits, candidates, *_):
        calls["candidates"] = candidates
        raise Stop

    monkeypatch.setattr(mq, "_V1", {})
    monkeypatch.setattr(mq, "_key", lambda spark, sf_dir: sf_dir)
    monkeypatch.setattr(mq, "_train", lambda spark, sf_dir: None)
    monkeypatch.setattr(cv, "prepared_folds", folds)
    monkeypatch.setattr(pp, "held_scores", held)
    with pytest.raises(Stop):
        mq._v1(None, "nowhere")
    return calls


def test_v1_build_has_all_repeats(v1_calls):
    assert (v1_calls["repeats"], v1_calls["folds"]) == (5, 5)
    assert "count(*) = 25" in mq.sql_cv_benchmark("scores")


def test_v1_families_have_their_own_sizes_in_every_fold(spark, v1_calls):
    assert v1_calls["candidates"] == {f: (f, None) for f in cv.FAMILIES} and len(cv.FAMILIES) == 5
    stages = {f: cv.estimators(f, p, 100)[0] for f, p in v1_calls["candidates"].values() if f in cv.TREE_FAMILIES}
    assert stages["random_forest"].getNumTrees() == 500 and stages["random_forest"].getMaxDepth() == 30
    assert [stages[f].getMaxIter() for f in ("gradient_boosting", "second_boosting")] == [150, 300]


def test_champion_and_challenger_are_fitted_at_their_own_sizes(spark, v1_calls, monkeypatch):
    made = {}

    def scores(train, **how):
        assert "sizes" not in how

    def fit_all(split, candidates, names, estimators):
        made.update({n: candidates[n] for n in names})
        raise Stop

    monkeypatch.setattr(cv, "held_scores", scores)
    monkeypatch.setattr(cv, "benchmark", lambda scores: None)
    monkeypatch.setattr(cv, "champion", lambda bench: "random_forest")
    monkeypatch.setattr(pp, "prepare", lambda *_: SimpleNamespace(model=None))
    monkeypatch.setattr(pp, "fit_all", fit_all)
    with pytest.raises(Stop):
        mq._v1(None, "nowhere")
    assert made == {f: (f, None) for f in ("random_forest", "logistic_regression")}


def test_v2_build_has_every_trial_of_its_mode(monkeypatch):
    asked = {}

    def out_of_fold(folds, candidates, quality):
        asked.update(candidates)
        raise Stop

    monkeypatch.setattr(mq, "_V2", {})
    monkeypatch.setattr(mq, "_key", lambda spark, sf_dir: sf_dir)
    monkeypatch.setattr(mq, "materialize", lambda *_: None)
    monkeypatch.setattr(enhanced, "prepared_folds", lambda *_: None)
    monkeypatch.setattr(enhanced, "out_of_fold", out_of_fold)
    with pytest.raises(Stop):
        mq._v2(None, "nowhere")
    assert set(asked) == {*enhanced.FAMILIES, *(f"{f}#{i}" for f in enhanced.TUNED for i in range(3))}
    assert len(enhanced.trial_candidates(quality="balanced")) == 4 * 12
