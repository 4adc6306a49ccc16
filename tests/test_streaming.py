"""availableNow file stream == batch routing counts."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    s = E.queries()["stream_route_counts"](spark, SF_SMALL)
    from decisionops.plans.analysis_frame import analysis_frame
    b = (analysis_frame(spark, SF_SMALL).groupBy(F.col("simulation_day").alias("day"),
                                                 F.col("baseline_route").alias("route"))
         .agg(F.count(F.lit(1)).alias("applications")))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.select("day", "route", "applications").collect()))


def test_any_number_of_files_per_trigger(spark, tmp_path):
    """Six files with event times over the whole period, read 1, 2 or 64 at a
    time, some rows delivered twice: the counts are those of one batch."""
    from decisionops.plans.fixtures import applications_v1_dated
    from decisionops.streaming.decisions import decisions, run_available_now
    apps = applications_v1_dated(spark, SF_SMALL)
    src = str(tmp_path / "in")
    apps.repartition(6).write.parquet(src)
    apps.limit(100).coalesce(1).write.mode("append").parquet(src)
    want = sorted(map(tuple, decisions(apps).groupBy("day", "route").count().collect()))
    for n in (1, 2, 64):
        out = run_available_now(spark, src, str(tmp_path / f"out{n}"), str(tmp_path / f"ck{n}"), n)
        assert sorted(map(tuple, out.select("day", "route", "applications").collect())) == want


def test_rows_too_late_are_reported(spark, tmp_path):
    import pytest

    from decisionops.plans.fixtures import applications_v1_dated
    from decisionops.streaming.decisions import run_available_now
    src = str(tmp_path / "in")
    applications_v1_dated(spark, SF_SMALL).repartition(6).write.parquet(src)
    with pytest.raises(RuntimeError, match="later than the watermark"):
        run_available_now(spark, src, str(tmp_path / "out"), str(tmp_path / "ck"), 1, watermark="1 hour")


def test_event_time_forms_for_any_number_of_files(spark, tmp_path):
    """Trend windows, quarantine and de-duplication of six files of random order, 1, 2 or 64 at a time: as in batch."""
    from decisionops.operators import clean as cl
    from decisionops.operators import validate as va
    from decisionops.plans.fixtures import V1_PREDICTORS, applications_v1_dated, applications_v2_raw
    from decisionops.streaming import applications as sa
    apps, raw = applications_v1_dated(spark, SF_SMALL), applications_v2_raw(spark, SF_SMALL)
    src, src2 = str(tmp_path / "v1"), str(tmp_path / "v2")
    apps.repartition(6).write.parquet(src)
    raw.union(raw).repartition(6).write.parquet(src2)
    trend = sorted(map(tuple, E.queries()["daily_trend"](spark, SF_SMALL).select(
        "date", "applications", "historical_approval_rate", "manual_review_rate").collect()))
    rows = apps.select("application_id", *V1_PREDICTORS)
    checked = {r.application_id: r.violations for r in va.validate_rows(rows, va.V1_RULES, "application_id").collect()}
    clean = sorted(map(str, (tuple(r[c] for c in [*cl.DEDUP_SUBSET, "loan_id"]) for r in cl.clean_v2(raw).collect())))
    for n in (1, 2, 64):
        at = str(tmp_path / f"run{n}")
        got = sa.daily_trend(spark, src, at + "/trend", at + "/ck1", n)
        assert sorted(map(tuple, got.select("date", "applications", "historical_approval_rate", "manual_review_rate")
                          .collect())) == trend
        good, bad = sa.quarantine(spark, src, at + "/rows", at + "/ck2", va.V1_RULES,
                                  lambda df: df.select("application_id", *V1_PREDICTORS), n)
        assert "violations" not in good.columns
        out = {r.application_id: "" for r in good.collect()} | {r.application_id: r.violations for r in bad.collect()}
        assert out == checked and good.count() + bad.count() == len(checked)
        first = sa.first_of_equal(spark, src2, at + "/first", at + "/ck3", cl.DEDUP_SUBSET, "loan_id",
                                  lambda df: cl.clip_assets(cl.normalize(df)), n)
        assert sorted(map(str, (tuple(r[c] for c in [*cl.DEDUP_SUBSET, "loan_id"]) for r in first.collect()))) == clean


def test_a_later_run_goes_on(spark, tmp_path):
    """New files on the same checkpoint: updated groups replace their earlier version."""
    from decisionops.streaming import applications as sa
    src, at = str(tmp_path / "in"), str(tmp_path / "run")
    spark.createDataFrame([(5, "a"), (7, "b"), (6, "a")], "id long, v string").write.parquet(src)
    assert sorted(map(tuple, sa.first_of_equal(spark, src, at, at + "-ck", ["v"], "id").collect())) == [("a", 5), ("b", 7)]
    spark.createDataFrame([(3, "b"), (9, "a"), (1, "c")], "id long, v string").write.mode("append").parquet(src)
    got = sa.first_of_equal(spark, src, at, at + "-ck", ["v"], "id").collect()
    assert sorted(map(tuple, got)) == [("a", 5), ("b", 3), ("c", 1)]
