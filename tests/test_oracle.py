"""Spark result == DuckDB oracle on sf0.001 for a representative subset."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

NAMES = ["policy_kpis_baseline", "policy_surface", "policy_optimum", "scenario_comparison",
         "segment_kpis_all_dims", "daily_trend", "funnel", "review_queue", "case_records",
         "clean_v2", "clean_v2_report", "validate_rows_v1", "dataset_checks", "describe_numeric",
         "stratified_split", "repeated_folds", "roc_auc", "fairness_slices", "feature_baselines",
         "scorecard_factors", "local_sensitivity", "leaderboard", "blend_search", "permutation_importance",
         "queue_filters", "case_records_nested", "cases_not_found", "decision_mix", "analysis_summary", "champion",
         "json_roundtrip", "csv_roundtrip", "staged_publish", "run_metadata", "file_fingerprint", "row_fingerprint",
         "stream_route_counts", "stream_daily_trend", "stream_quarantine", "stream_clean", "top_lists",
         "validate_rows_partial", "scenario_report", "quality_profile", "describe_numeric"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 9):.9f}"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, rel.fetchall())


def test_registry_complete():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 60


def test_entry_runs(spark):
    assert E.entry(spark).count() == 1
