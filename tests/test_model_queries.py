"""The registered model queries against their oracles over published scores, with small models."""

import pytest

import __spark_entry__ as E
from decisionops.ml import candidates, enhanced
from decisionops.plans import ml_queries as mq
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows

NAMES = ["oof_scores", "cv_benchmark", "holdout_eval", "holdout_eval_svm", "fairness_model", "model_roundtrip",
         "fitted_scores", "fitted_score_check", "fitted_factors", "fitted_predictions", "fitted_importance",
         "champion_importance", "v2_tuning", "tuned_search", "v2_oof_scores", "v2_benchmark", "v2_blend", "v2_holdout",
         "v2_bundle", "bundle_scores", "bundle_sensitivity", "bundle_importance", "member_importance"]


@pytest.fixture(scope="module")
def small_models():
    """A few trees and rounds instead of hundreds; folds, families, trials and queries stay."""
    patch = pytest.MonkeyPatch()
    for name, value in {"FOREST_TREES": 4, "BOOST_ROUNDS": 2, "SECOND_ROUNDS": 3, "UNLIMITED_DEPTH": 5}.items():
        patch.setattr(candidates, name, value)
    patch.setattr(enhanced, "UNLIMITED_DEPTH", 5)
    patch.setattr(enhanced, "TREES", {"fast": 5})
    patch.setattr(enhanced, "BOOSTS", {"fast": 2})
    for name in ("TUNED_TREES", "TUNED_BOOSTS"):
        patch.setitem(getattr(enhanced, name), "fast", (2, 4, 1))
    patch.setattr(mq, "V1_SIZES", {})
    patch.setattr(mq, "V2_TRIALS", 3)
    patch.setattr(mq, "_V1", {})
    patch.setattr(mq, "_V2", {})
    yield
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, small_models, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    want = _rows(cols, rel.fetchall())
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == want and want


def test_every_family_and_trial_is_there(spark, small_models):
    """Five families in every fold, three trials for each of the four tuned ones, untuned replaced by the best."""
    b = mq._v1(spark, SF_SMALL)
    per = {(r.model, r.repeat, r.fold) for r in b.scores.select("model", "repeat", "fold").distinct().collect()}
    assert len(per) == 5 * 5 * mq.V1_REPEATS and b.champion in candidates.TREE_FAMILIES
    v = mq._v2(spark, SF_SMALL)
    assert len(v.trials) == 4 * enhanced.TRIALS["fast"] == 12
    assert {r.model for r in v.oof.select("model").distinct().collect()} == set(enhanced.FAMILIES)
    assert v.scores.select("model").distinct().count() == 5 + 12


def test_oracles_need_a_session():
    """Without a session nobody knows the folder of the artifacts: the entries are left out."""
    from decisionops.plans import artifacts
    patch = pytest.MonkeyPatch()
    patch.setattr(artifacts, "artifact_sql", lambda name: None)
    assert "cv_benchmark" not in E.oracle_sql() and "clean_v2" in E.oracle_sql()
    patch.undo()
