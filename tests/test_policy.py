"""Policy engine: one-pass grid equals per-policy brute force; invariants."""

import pytest
from pyspark.sql import functions as F

from decisionops.operators import policy as pol
from decisionops.plans.analysis_frame import ROUTE_APPROVE, ROUTE_MANUAL, ROUTE_REJECT, analysis_frame, route
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def frame(spark):
    return analysis_frame(spark, SF_SMALL)


def _direct(frame, a, r):
    rt = route("approval_probability", a, r)
    h = F.col("historical_approved")
    return frame.agg(
        F.count_if(rt == ROUTE_APPROVE).alias("auto_approve"),
        F.count_if(rt == ROUTE_REJECT).alias("auto_reject"),
        F.count_if(rt == ROUTE_MANUAL).alias("manual_review"),
        F.count_if(((rt == ROUTE_APPROVE) & h) | ((rt == ROUTE_REJECT) & ~h)).alias("agree"),
        F.sum(F.when(rt == ROUTE_MANUAL, F.col("estimated_review_minutes"))).alias("minutes")).first()


def test_surface_matches_direct_filter(frame):
    surf = {(r["approve_threshold"], r["reject_threshold"]): r for r in pol.policy_surface(frame).collect()}
    assert len(surf) == 289
    for a, r in [(0.55, 0.05), (0.75, 0.25), (0.95, 0.45), (0.625, 0.375), (0.9, 0.1)]:
        got, d = surf[(a, r)], _direct(frame, a, r)
        assert (got["auto_approve"], got["auto_reject"], got["manual_review"]) == \
               (d["auto_approve"], d["auto_reject"], d["manual_review"])
        auto = d["auto_approve"] + d["auto_reject"]
        assert got["auto_historical_agreement"] == round(d["agree"] / auto if auto else 1.0, 6)
        assert got["estimated_review_hours"] == round((d["minutes"] or 0.0) / 60.0, 2)


def test_stricter_thresholds_do_not_lower_manual_rate(frame):
    loose = pol.policy_metrics(frame, 0.6, 0.4).first()
    strict = pol.policy_metrics(frame, 0.9, 0.1).first()
    assert strict["manual_review_rate"] >= loose["manual_review_rate"]


def test_volume_scales_utilisation(frame):
    one = pol.policy_metrics(frame, 0.75, 0.25, volume_multiplier=1.0).first()
    two = pol.policy_metrics(frame, 0.75, 0.25, volume_multiplier=2.0).first()
    assert two["capacity_utilization"] >= one["capacity_utilization"]
    assert two["estimated_review_hours"] >= one["estimated_review_hours"]


def test_optimum_respects_guardrail_or_falls_back(frame):
    for g in (0.85, 0.999):
        r = pol.optimize_policy(frame, g).first()
        if r["feasible"]:
            assert r["auto_historical_agreement"] + 1e-12 >= r["minimum_auto_agreement"]
        else:
            assert (r["approve_threshold"], r["reject_threshold"]) == pol.FALLBACK_POLICY


def test_invalid_thresholds_refused(frame):
    with pytest.raises(ValueError):
        pol.policy_metrics(frame, 0.4, 0.6)
    with pytest.raises(ValueError):
        pol.policy_metrics(frame, 0.75, 0.25, analysts=0)


def test_rates_in_unit_interval(frame):
    r = pol.policy_metrics(frame).first()
    for k in ("auto_decision_rate", "manual_review_rate", "auto_historical_agreement",
              "historical_approval_auto_capture", "historical_rejection_auto_capture"):
        assert 0.0 <= r[k] <= 1.0
    f = frame.agg(F.min("approval_probability"), F.max("approval_probability"),
                  F.min("document_completeness"), F.max("document_completeness")).first()
    assert 0 <= f[0] <= f[1] <= 1 and 0.55 <= f[2] <= f[3] <= 1


def test_full_report_sections(spark):
    from decisionops.plans.report import business_analysis_report
    rep = business_analysis_report(spark, SF_SMALL)
    assert rep["policy"].count() == 1 and rep["optimized_policy"].count() == 1
    assert rep["queue"].count() == 40 and rep["trends"].count() > 20
    with pytest.raises(ValueError):
        business_analysis_report(spark, SF_SMALL, approve=0.72, reject=0.72)


def test_case_record_nested_form(spark):
    from decisionops.operators.queue import case_record_nested, case_records
    f = analysis_frame(spark, SF_SMALL)
    req = spark.createDataFrame([(0,), (1,), (10 ** 12,)], "application_id long")
    flat = case_records(f, req)
    rows = {r["application_id"]: r for r in case_record_nested(flat, "scorecard_v1", "1").collect()}
    assert rows[10 ** 12]["found"] is False and rows[0]["found"] is True
    assert rows[0]["applicant"]["property_area"] is not None or rows[0]["applicant"]["income"] is not None
    assert "simulation_fields" in rows[0]["audit"].asDict()


def test_thousand_thresholds(spark):
    """Bins of many thresholds equal counting them."""
    import random

    from pyspark.sql import functions as F

    from decisionops.operators.policy import bin_ids
    rnd = random.Random(4)
    a = sorted({round(rnd.uniform(0.5, 1), 6) for _ in range(1000)})
    r = sorted({round(rnd.uniform(0, 0.5), 6) for _ in range(1000)})
    ps = [None, 0.0, 1.0, *a[:40], *r[:40], *(rnd.random() for _ in range(200))]
    ia, ir = bin_ids(F.col("p"), a, r)
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", ia.alias("a"), ir.alias("r")).collect()
    for x in rows:
        if x.p is None:
            assert (x.a, x.r) == (0, len(r))
        else:
            assert x.a == sum(t <= x.p for t in a) and x.r == sum(t < x.p for t in r)


def test_ties_take_the_smaller_name(spark):
    from decisionops.plans.scorecard_queries import pick_champion
    lead = spark.createDataFrame([("b", 0.8, 0.7), ("a", 0.8, 0.7), ("c", 0.8, 0.6)],
                                 "model string, auc_mean double, balanced_accuracy_mean double")
    assert pick_champion(lead).first().model == "a"


def test_queue_finds_matches_of_any_rank(spark):
    from decisionops.operators import queue as q
    from decisionops.plans.analysis_frame import analysis_frame
    from tests.conftest import SF_SMALL
    f = analysis_frame(spark, SF_SMALL)
    found = q.filtered_queue(f, "all", "analyst b", limit=10**6)
    want = q.queue_candidates(f).where(q.matches("analyst b"))
    assert found.count() == want.count() > 5
    last = found.orderBy("priority").first().application_id          # far below any top list of all cases
    assert last in {r.application_id for r in q.filtered_queue(f, "all", f"{last} ", limit=5).collect()}
    import pytest
    with pytest.raises(ValueError):
        q.review_queue(f, limit=0)
