"""Hand-made frames for the semantic traps (null vs NaN, bands, medians,
ranks, ties, rounding, de-duplication, validation)."""

import math

from pyspark.sql import functions as F

from decisionops.functions.columns import clip, fround, nan_to_null
from decisionops.operators import clean as cl
from decisionops.operators import globalrank as gr
from decisionops.operators import validate as va
from decisionops.operators.features import add_v1_features, add_v2_features
from decisionops.plans.analysis_frame import route


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.5,), (2.0,)], "x double")
    got = [r[0] for r in df.select(clip("x", 0.0, 1.0)).collect()]
    assert got == [None, 0.0, 0.5, 1.0]


def test_nan_score_routes_to_manual(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.75,), (0.25,), (0.5,)], "p double")
    got = [r[0] for r in df.select(route(nan_to_null(F.col("p")), 0.75, 0.25)).collect()]
    assert got == ["Manual review", "Manual review", "Auto approve", "Auto reject", "Manual review"]


def test_band_is_right_closed(spark):
    df = spark.createDataFrame([(499,), (500,), (649,), (650,), (749,), (750,), (760,), (None,)], "cibil_score int")
    for c in ["income_annum", "loan_amount", "loan_term", "residential_assets_value", "commercial_assets_value",
              "luxury_assets_value", "bank_asset_value"]:
        df = df.withColumn(c, F.lit(1.0))
    got = [r[0] for r in add_v2_features(df).select("cibil_band").collect()]
    assert got == ["weak", "fair", "fair", "good", "good", "excellent", "excellent", None]


def test_v2_total_assets(spark):
    df = spark.createDataFrame([(5e6, 3e6, 10e6, 5e6, 9e6, 12e6, 20, 760)],
                               "income_annum double, loan_amount double, residential_assets_value double, "
                               "commercial_assets_value double, luxury_assets_value double, bank_asset_value double, "
                               "loan_term int, cibil_score int")
    r = add_v2_features(df).first()
    assert r["total_assets"] == 36e6 and r["cibil_band"] == "excellent"


def test_v1_total_income(spark):
    df = spark.createDataFrame([(5000.0, 1500.0, 120.0, 360.0)],
                               "applicant_income double, coapplicant_income double, loan_amount double, "
                               "loan_amount_term double")
    r = add_v1_features(df).first()
    assert r["total_income"] == 6500.0 and r["loan_to_annual_income"] > 0 and r["monthly_principal_proxy"] > 0


def test_v1_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(0.0, None, 100.0, 0.0)],
                               "applicant_income double, coapplicant_income double, loan_amount double, "
                               "loan_amount_term double")
    r = add_v1_features(df).first()
    assert r["loan_to_annual_income"] is None and r["monthly_principal_proxy"] is None


def test_exact_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert gr.exact_median(df, "v").first()[0] == 2.5
    q = {r["q"]: r["value"] for r in gr.exact_quantiles(df, "v", [0.25, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.75: 3.25}


def test_exact_quantiles_negative_and_ties(spark):
    vals = [-5.0, -5.0, -1.0, 0.0, 0.0, 0.0, 2.5, 1e6]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    import numpy as np
    for q in (0.1, 0.5, 0.9):
        got = gr.exact_quantiles(df, "v", [q]).first()["value"]
        assert math.isclose(got, float(np.quantile(vals, q)), rel_tol=1e-12, abs_tol=1e-12)


def test_percent_rank_averages_ties_and_nulls_zero(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (4, 30.0), (5, None)], "id int, v double")
    got = {r["id"]: r["pct"] for r in gr.percent_rank_avg(df, "v", "pct").collect()}
    assert got == {1: 0.25, 2: 0.5, 3: 0.875, 4: 0.875, 5: 0.0}


def test_auc_half_credit_for_ties(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.8, 1), (0.3, 0)]
    df = spark.createDataFrame(rows, "p double, y int")
    pos = [p for p, y in rows if y == 1]
    neg = [p for p, y in rows if y == 0]
    brute = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
    assert math.isclose(gr.rank_sum_auc(df, "p", "y").first()["auc"], brute)


def test_fround_matches_ieee_formula(spark):
    xs = [2.675, 0.125, -1.5, 936.5811875, 1 / 3]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(fround("x", 6)).collect()]
    assert got == [math.floor(x * 1e6 + 0.5) / 1e6 for x in xs]


def test_dedup_ignores_id_keeps_first_and_null_equals_null(spark):
    rows = [(3, "a", None), (1, "a", None), (2, "b", 1.0), (5, "b", 1.0), (4, "c", 2.0)]
    df = spark.createDataFrame(rows, "loan_id int, k string, v double")
    got = sorted(r["loan_id"] for r in cl.deduplicate(df, ["k", "v"], "loan_id").collect())
    assert got == [1, 2, 4]


def test_row_validation_rules(spark):
    df = spark.createDataFrame([(1, -1.0, 100.0), (2, 5000.0, 100.0), (3, 5000.0, None), (4, float("inf"), 10.0)],
                               "id int, applicant_income double, loan_amount double")
    rules = {k: va.V1_RULES[k] for k in ("applicant_income", "loan_amount", "loan_amount_term")}
    got = {r["id"]: r["violations"] for r in va.validate_rows(df, rules, "id").collect()}
    assert got == {1: "applicant_income", 2: "", 3: "loan_amount", 4: "applicant_income"}


def test_v2_cibil_out_of_range(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 750.0)], "id int, cibil_score double")
    got = {r["id"]: r["valid"] for r in va.validate_rows(df, {"cibil_score": va.V2_RULES["cibil_score"]},
                                                         "id").collect()}
    assert got == {1: False, 2: True}


def test_forbidden_field_is_reported(spark):
    df = spark.createDataFrame([(1, "Male", 100.0)], "id int, gender string, loan_amount double")
    res = {r["check"]: r["passed"] for r in
           va.dataset_checks(df, va.Expectation("t", ("id", "loan_amount"), forbidden=("gender",))).collect()}
    assert res["t.forbidden_columns"] is False and res["t.required_columns"] is True


def test_scenario_validation(spark):
    df = spark.createDataFrame([
        (0.75, 0.25, 1, 6.0, 1.0, "channel"),
        (0.78, 0.72, 1, 6.0, 1.0, "channel"),
        (0.40, 0.45, 0, 13.0, 20.0, "gender"),
    ], "approve_threshold double, reject_threshold double, analysts int, productive_hours double, "
       "volume_multiplier double, segment_dimension string")
    got = [r["violations"] for r in va.scenario_violations(df).collect()]
    assert got[0] == "" and "reject_threshold" in got[1]
    assert set(got[2].split(",")) >= {"approve_threshold", "threshold_order", "analysts", "productive_hours",
                                      "volume_multiplier", "segment_dimension"}


def test_normalize_names_and_labels(spark):
    df = spark.createDataFrame([(1, " Approved ", " 5 "), (2, " Rejected", "x"), (3, "Maybe", "1")],
                               "loan_id int, ` loan_status` string, ` cibil_score` string")
    out = cl.normalize(df).orderBy("loan_id").collect()
    assert [r["target"] for r in out] == [1, 0, None]
    assert [r["cibil_score"] for r in out] == [5.0, None, 1.0]
