"""The clever binning paths against brute force on edge values."""

import random

from pyspark.sql import functions as F

from decisionops.operators import blend as bl
from decisionops.operators import policy as pol


def test_threshold_bin_equals_count(spark):
    rnd = random.Random(7)
    ps = [rnd.random() for _ in range(400)] + bl.THRESHOLDS + [t + 1e-12 for t in bl.THRESHOLDS] \
        + [t - 1e-12 for t in bl.THRESHOLDS] + [0.0, 1.0, 0.3, 0.7, None]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [(r[0], r[1]) for r in df.select("p", bl.threshold_bin(F.col("p"))).collect()]
    for p, b in got:
        expect = 0 if p is None else sum(1 for t in bl.THRESHOLDS if t <= p)
        assert b == expect, (p, b, expect)


def test_policy_bins_inclusive_bounds_and_nulls(spark):
    ps = [0.75, 0.25, None, 0.5, 0.55, 0.95, 0.05, 0.45, 0.7499999, 0.2500001]
    rows = [(i, p, i % 2 == 0, "2026-09-01", 10.0, 1000.0) for i, p in enumerate(ps)]
    frame = spark.createDataFrame(rows, "application_id int, approval_probability double, "
                                        "historical_approved boolean, simulation_day string, "
                                        "estimated_review_minutes double, loan_value double")
    surf = {(r["approve_threshold"], r["reject_threshold"]): r for r in pol.policy_surface(frame).collect()}
    local = [(p, i % 2 == 0) for i, p in enumerate(ps)]
    for a in pol.GRID_APPROVE:
        for r in pol.GRID_REJECT[::4]:
            appr = sum(1 for p, _ in local if p is not None and p >= a)
            rej = sum(1 for p, _ in local if p is not None and not p >= a and p <= r)
            got = surf[(a, r)]
            assert (got["auto_approve"], got["auto_reject"], got["manual_review"]) == \
                   (appr, rej, len(ps) - appr - rej), (a, r)
