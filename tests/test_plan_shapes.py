"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_queue_is_top_k_with_pushed_range_filter(spark):
    p = _plan(E.queries()["review_queue"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "PushedFilters: [Or(And(LessThan(approval_probability,0.75),GreaterThan(approval_probability,0.25))" in p


def test_policy_grid_prunes_columns_and_never_windows_over_rows(spark):
    """The rows are read once, a handful of their columns; policies read the stored cells alone."""
    from decisionops.operators.policy import route_cells
    from decisionops.plans.analysis_frame import analysis_frame
    cells = route_cells(analysis_frame(spark, SF_SMALL), [0.75], [0.25])
    schemas = [ln for ln in _plan(cells).splitlines() if ln.startswith("ReadSchema")]
    assert len(schemas) == 1 and schemas[0].count(":") <= 6          # one of the colons is the label's
    p = _plan(E.queries()["policy_surface"](spark, SF_SMALL))
    read = [ln.split("struct<")[1].rstrip(">").split(",") for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert read and all(c.split(":")[0] in cells.columns for cols in read for c in cols)
    assert "Window" not in p                                         # cells, not ranked rows


def test_dedup_is_an_aggregate_not_a_window(spark):
    p = _plan(E.queries()["clean_v2"](spark, SF_SMALL))
    assert "HashAggregate" in p and "SortAggregate" not in p
    assert "row_number" not in p


def test_split_windows_are_partitioned_by_bucket(spark):
    p = _plan(E.queries()["stratified_split"](spark, SF_SMALL))
    # the row-level ranking window runs inside (label, bucket) partitions
    rn = [ln for ln in p.splitlines() if "row_number()" in ln]
    assert rn and all("_bkt" in ln for ln in rn)


def test_queue_presets_share_one_ranking(spark):
    p = _plan(E.queries()["queue_filters"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p                         # k cases a preset and task before the last ranking
    scans = [ln for ln in p.splitlines() if ln.startswith("(") and ") Scan parquet" in ln]
    assert len(scans) <= 5                                 # rows twice, ranks three times; not once a preset


def test_lists_are_limited_where_they_are_ranked(spark):
    assert "WindowGroupLimit" in _plan(E.queries()["top_lists"](spark, SF_SMALL))


def test_only_rows_of_repeated_ids_are_compared(spark):
    p = _plan(E.queries()["quality_profile"](spark, SF_SMALL))
    assert "LeftSemi" in p


def test_factors_are_sorted_without_a_comparator(spark):
    assert "lambda" not in _plan(E.queries()["scorecard_factors"](spark, SF_SMALL))


def test_ensemble_members_are_scored_in_one_pass(spark):
    """Several fitted members on one scan of the rows, without a join."""
    from decisionops.ml import enhanced as en
    train = en.training_frame(spark, SF_SMALL)
    small = {n: ("random_forest", {"n_estimators": k, "max_depth": 2}) for n, k in (("a", 2), ("b", 3), ("c", 2))}
    bundle = en.fit_bundle(train, small, list(small), [0.2, 0.3, 0.5], 0.5, {})
    rows = spark.read.parquet(_written(train))
    p = _plan(en.ensemble_scores(rows, bundle))
    assert "Join" not in p and p.count("Scan parquet") == 2          # the tree of operators, and the scan's details


def _written(df) -> str:
    import tempfile
    path = tempfile.mkdtemp(prefix="decisionops-plan-") + "/rows"
    df.write.parquet(path)
    return path


def test_draws_are_not_stored_with_the_joined_orders(spark):
    """Each layout makes the draws it reads; the table that both read holds none."""
    from decisionops.plans.fixtures import order_base
    assert not [c for c in order_base(spark, SF_SMALL).columns if c.startswith("u_")]


def test_fits_keep_only_the_training_rows_and_the_vector_they_read(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.sql import functions as F

    from decisionops.ml import candidates, cv
    from decisionops.ml import prepared as pp
    seen = []

    class Seen(LogisticRegression):
        def _fit(self, rows):
            seen.append((set(rows.columns), rows.storageLevel.useMemory, rows.count()))
            return super()._fit(rows)

    split = pp.prepare(cv.training_frame(spark, SF_SMALL), cv.v1_stages(), F.col("split") == "test", "application_id")
    pp.fit_all(split, {"m": ("any", None)}, ["m"], lambda *_: [Seen(featuresCol="scaled", maxIter=2)])
    assert seen == [({"label", "weight", "scaled"}, True, split.n_train)]
    assert [pp.vector_read(candidates.estimators(f, None, 10)) for f in candidates.FAMILIES] == [
        "scaled", "plain", "plain", "scaled", "plain"]


def test_rows_are_dealt_out_before_they_become_vectors(spark, monkeypatch):
    """The shuffle that sizes the partitions of prepared rows moves raw columns."""
    from pyspark.sql import functions as F

    from decisionops.ml import cv
    from decisionops.ml import prepared as pp
    dealt, kind = [], type(spark.range(1))
    real = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda df, *a: dealt.append(df.columns) or real(df, *a))
    pp.prepare(cv.training_frame(spark, SF_SMALL), cv.v1_stages(), F.col("split") == "test", "application_id")
    assert len(dealt) == 1 and "loan_amount" in dealt[0] and not {"plain", "scaled"} & set(dealt[0])
