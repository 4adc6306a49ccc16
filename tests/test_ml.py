"""Spark ML pieces: exact imputer, pipeline persistence, CSV source."""

import tempfile

from pyspark.ml import Pipeline, PipelineModel

from decisionops.ml.preprocess import ExactImputer


def test_exact_imputer_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "a"), (4.0, "b"), (None, None)], "x double, c string")
    m = ExactImputer(numericCols=["x"], categoricalCols=["c"]).fit(df)
    rows = m.transform(df).collect()
    assert rows[-1]["x"] == 2.5 and rows[-1]["c"] == "a"      # interpolated median; tie -> smallest


def test_imputer_persists(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    model = Pipeline(stages=[ExactImputer(numericCols=["x"], categoricalCols=[])]).fit(df)
    path = tempfile.mkdtemp(prefix="decisionops-model-") + "/m"
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert [r[0] for r in back.transform(df).collect()] == [1.0, 3.0, 2.0]


def test_csv_roundtrip_keeps_rows_and_nulls(spark):
    import __spark_entry__ as E
    from decisionops.plans.fixtures import applications_v1
    from tests.conftest import SF_SMALL
    r = E.queries()["csv_roundtrip"](spark, SF_SMALL).first()
    a = applications_v1(spark, SF_SMALL)
    assert r["rows"] == a.count()
    assert r["null_loan_amount"] == a.where("loan_amount IS NULL").count() and r["differing_rows"] == 0


def test_unseen_level_is_all_zeros_and_only_numbers_are_scaled(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from decisionops.ml.preprocess import V1_NUMERIC, v1_stages
    from decisionops.plans.fixtures import applications_v1
    from tests.conftest import SF_SMALL
    a = applications_v1(spark, SF_SMALL)
    model = Pipeline(stages=v1_stages()).fit(a)
    odd = a.limit(1).withColumn("property_area", F.lit("Offshore"))
    row = model.transform(odd.unionByName(a.where("property_area = 'Rural'").limit(1))).select("property_area_ohe").collect()
    assert sorted(r[0].toArray().sum() for r in row) == [0.0, 1.0] and row[0][0].size == 3
    rows = model.transform(a).select("plain", "scaled").collect()
    plain, scaled = (np.array([r[c].toArray() for r in rows]) for c in ("plain", "scaled"))
    n = len(V1_NUMERIC)
    assert np.allclose(scaled[:, :n].mean(0), 0, atol=1e-9) and np.allclose(scaled[:, :n].std(0), 1)      # population
    assert (scaled[:, n:] == plain[:, n:]).all() and set(np.unique(scaled[:, n:])) == {0.0, 1.0}


def test_kernel_width_and_features_of_the_data(spark):
    """gamma is 1 / (slots x variance of all entries); the features approximate that kernel."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from decisionops.ml.rff import RandomFourierFeatures
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6)) * 3 + 1
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "scaled"])
    model = RandomFourierFeatures(numFeatures=4000).fit(df)
    gamma = model.getOrDefault(model.gamma)
    assert abs(gamma - 1 / (6 * x.var())) < 1e-12
    z = np.array([r.rff.toArray() for r in model.transform(df).orderBy("id").collect()])
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.12
    assert model.transform(df.where("id < 0")).count() == 0


def test_tuning_ranges():
    from decisionops.ml import enhanced as en
    for family, ranges in en.RANGES.items():
        for quality in ("fast", "balanced", "max"):
            drawn = en.sample_params(family, 40, quality)
            assert drawn == en.sample_params(family, 40, quality) and len(drawn) == 40
            for p in drawn:
                assert set(p) == set(ranges)
                for name, (kind, *of) in ranges.items():
                    if kind == "steps":
                        low, high, step = of[0][quality]
                        assert low <= p[name] <= high and (p[name] - low) % step == 0
                    elif kind == "one of":
                        assert p[name] in of[0]
                    else:
                        assert of[0] <= p[name] <= of[1]
            assert all(en.estimators(quality)(family, p, 100) for p in drawn[:3])


def test_v2_finalists_blend_and_bundle(spark, tmp_path):
    """Two families, small sizes: order of finalists, blend by brute force, bundle round trip, scores of one row
    and its sensitivity by hand."""
    import numpy as np
    from pyspark.sql import functions as F

    from decisionops.ml import enhanced as en
    from tests.conftest import SF_SMALL
    train = en.training_frame(spark, SF_SMALL).persist()
    candidates = {"logistic_regression": ("logistic_regression", None),
                  "random_forest#0": ("random_forest", {"n_estimators": 5, "max_depth": 3, "class_weight": "balanced"}),
                  "random_forest#1": ("random_forest", {"n_estimators": 3, "max_depth": 2})}
    folds = en.prepared_folds(train)
    assert all(f.rows.where("held").count() + f.n_train == train.where("split = 'dev'").count() for f in folds.values())
    oof = en.out_of_fold(folds, candidates).persist()
    rows = oof.collect()
    dev = train.where("split = 'dev'").count()
    assert len(rows) == 3 * dev
    trials = {n: c for n, c in candidates.items() if "#" in n}
    tuning = en.tuning_table(oof, trials).collect()
    assert [r.model for r in tuning] == ["random_forest"] * 2 and sum(r.best for r in tuning) == 1
    top = max(tuning, key=lambda r: (r.cv_accuracy, -r.trial))
    assert top.best and en.with_tuned(en.tuning_table(oof, trials))["random_forest"][1] == trials[f"random_forest#{top.trial}"][1]
    names = en.finalists(oof, 2)
    acc = {n: np.mean([(r.p >= 0.5) == r.y for r in rows if r.model == n]) for n in candidates}
    assert [acc[n] for n in names] == sorted(acc.values(), reverse=True)[:2]
    best = en.blend(oof, names).first()
    y = {r.loan_id: r.y for r in rows}
    p = [{r.loan_id: r.p for r in rows if r.model == n} for n in names]
    ids = sorted(y)
    reach = max(np.mean([(w / 10 * p[0][i] + (10 - w) / 10 * p[1][i] >= t / 100) == y[i] for i in ids])
                for w in range(11) for t in range(30, 71, 5))
    assert best.accuracy >= reach - 1e-9
    bundle = en.fit_bundle(train, candidates, names, [best.w1, best.w2], best.threshold, {"a": 1})
    en.save_bundle(spark, str(tmp_path / "b"), bundle)
    loaded = en.load_bundle(spark, str(tmp_path / "b"))
    for k in ("weights", "threshold", "baselines", "metadata"):
        assert getattr(loaded, k) == getattr(bundle, k)
    assert list(loaded.members) == names and len(loaded.baselines) == 11
    test = train.where("split = 'test'")
    scored = {r.loan_id: r for r in en.ensemble_scores(test, bundle).collect()}
    again = {r.loan_id: r.p for r in en.ensemble_scores(test, loaded).collect()}
    assert all(abs(again[i] - r.p) < 1e-12 for i, r in scored.items())
    assert all(abs(r.p - best.w1 * r[f"p_{names[0]}"] - best.w2 * r[f"p_{names[1]}"]) < 1e-12 for r in scored.values())

    one = test.orderBy("loan_id").limit(1)
    i = one.first().loan_id
    moved = {}
    for f, v in loaded.baselines.items():
        changed = one.withColumn(f, F.lit(v).cast(one.schema[f].dataType))
        moved[f] = scored[i].p - en.ensemble_scores(changed, loaded).first().p
    want = sorted(moved, key=lambda f: (-abs(round(moved[f], 6)), f))[:6]
    got = en.sensitivity(en.sensitivity_scores(one, loaded)).orderBy("rank").collect()
    assert [r.feature for r in got] == want
    assert all(abs(r.contribution - moved[r.feature]) < 1e-6 for r in got) and got[0].label in en.LABELS.values()
    out = en.predictions(one, loaded).first()
    assert out.likely_approved == (scored[i].p >= loaded.threshold) and len(out.ensemble_members) == 2

    perm = en.permutation_scores(test, loaded, repeats=2).persist()
    n = test.count()
    assert perm.count() == n * (1 + 11 * 2)
    base = perm.where(F.col("feature") == en.BASE).collect()
    assert all(abs(r.p - scored[r.loan_id].p) < 1e-12 for r in base)
    imp = {r.feature: r for r in en.permutation_importance(perm, loaded.threshold).collect()}
    right = np.mean([(r.p >= loaded.threshold) == (r.label == 1) for r in base])
    drops = [right - np.mean([(r.p >= loaded.threshold) == (r.label == 1) for r in
                              perm.where((F.col("feature") == "cibil_score") & (F.col("repeat") == k)).collect()]) for k in (0, 1)]
    assert abs(imp["cibil_score"].importance - np.mean(drops)) < 1e-6 and abs(imp["cibil_score"].std - np.std(drops)) < 1e-6


def test_tree_digest_of_files(spark, tmp_path):
    """Bytes of several files, whatever the splits: equal to the digest of the bytes themselves."""
    import os
    import random

    from decisionops.sources.digest import file_digests, tree_digest
    rnd = random.Random(3)
    contents = {"a.bin": rnd.randbytes(300_000), "b.txt": b"one\r\ntwo\n\nthree", "c.txt": b"one\r\ntwo\n\nthree\n",
                "d.bin": b"\x00" * 5000 + b"\n" * 9000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    want = {n: (len(c), tree_digest(c, 64)) for n, c in contents.items()}
    assert len({d for _, d in want.values()}) == 4
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "1000", "77777"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.file: (r.bytes, r.digest) for r in file_digests(spark, str(tmp_path), 64).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    changed = bytearray(contents["a.bin"])
    changed[150_000] ^= 1
    assert tree_digest(bytes(changed), 64) != want["a.bin"][1] and os.listdir(tmp_path)


def test_run_log_grows(spark, tmp_path):
    from pyspark.sql import functions as F

    from decisionops.sources import io
    log = str(tmp_path / "log")
    record = spark.range(1).select(F.current_timestamp().alias("created_at"))
    for run, members in enumerate(([("a", 0.4), ("b", 0.6)], [("a", 1.0)])):
        m = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(w).alias("weight")) for n, w in members])
        io.append_run(record.select(F.lit(run).alias("run"), m.alias("members"), "created_at"), log)
        if run == 0:
            then = io.read_runs(spark, log).first().created_at
    rows = io.read_runs(spark, log).orderBy("run").collect()
    assert [(r.run, [(m.model, m.weight) for m in r.members]) for r in rows] == [(0, [("a", 0.4), ("b", 0.6)]), (1, [("a", 1.0)])]
    assert [r.run for r in io.read_runs(spark, log, then).collect()] == [0]


def test_published_version_survives_a_bad_load(spark, tmp_path):
    from pyspark.sql import functions as F

    from decisionops.sources import io

    def checks(df):
        return df.agg((F.min("x") >= 0).alias("ok")).select(F.lit("x").alias("check"), F.col("ok").alias("passed"),
                                                            F.lit("").alias("detail"))
    out = str(tmp_path / "published")
    for k, (values, status) in enumerate([([1, 2], "published"), ([-1], "rejected"), ([3], "published")]):
        df = spark.createDataFrame([(v,) for v in values], "x long")
        got = io.staged_publish(df, str(tmp_path / f"staging{k}"), out, checks).first()
        assert got.status == status
        want = [1, 2] if k < 2 else [3]
        assert sorted(r.x for r in io.read_published(spark, out).collect()) == want


def test_deep_forests_cache_nodes_and_grow_the_same_trees(spark):
    """Forests of both builds keep the rows' nodes (a level sends open nodes only); the trees are those without it."""
    import random

    from pyspark.ml.linalg import Vectors

    from decisionops.ml import candidates
    from decisionops.ml import enhanced as en
    from decisionops.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rnd = random.Random(5)
    rows = spark.createDataFrame([(float(rnd.random() < 0.4), rnd.uniform(0.5, 2.0), Vectors.dense([rnd.random() for _ in range(6)]))
                                  for _ in range(600)], ["label", "weight", "plain"]).repartition(3).persist()
    forests = [candidates.estimators("random_forest", {"numTrees": 6, "maxDepth": 14}, 600)[0]]
    for family, weights in (("random_forest", "balanced"), ("extra_trees_standin", None)):
        forests += en.estimators("fast")(family, {"n_estimators": 6, "class_weight": weights}, 600)
    for forest in forests:
        assert forest.getCacheNodeIds()
        cached, plain = forest.fit(rows), forest.copy().setCacheNodeIds(False).fit(rows)
        assert max(t.depth for t in cached.trees) > 10          # past a checkpoint of the rows' nodes
        assert [t.toDebugString.split("\n", 1)[1] for t in cached.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]
    rows.unpersist()


def test_fits_that_pack_their_rows_keep_no_second_copy(spark, monkeypatch):
    """Logistic and SVM fits read the stored rows; the scores are those of a fit on kept rows."""
    from types import SimpleNamespace

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from decisionops.ml import candidates
    from decisionops.ml import prepared as pp
    rows = spark.createDataFrame([(i, float(i % 3 == 0), 1.0, Vectors.dense([i % 7, i % 5, 1.0])) for i in range(200)],
                                 ["id", "label", "weight", "scaled"])
    split, seen, fit = SimpleNamespace(train=lambda: rows, n_train=200), [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: seen.append(df.storageLevel.useMemory) or fit(self, df),
                        raising=False)
    names = ["logistic_regression", "rbf_svm_standin"]
    made = pp.fit_all(split, {n: (n, None) for n in names}, names, candidates.estimators)
    assert seen == [False, False]
    scored = made[names[0]].transform(rows)
    p = [r[0] for r in scored.select(pp.p1(scored)).collect()]
    kept = rows.persist()
    again = candidates.estimators("logistic_regression", None, 200)[0].fit(kept).transform(kept)
    assert all(abs(a - b[0]) < 1e-9 for a, b in zip(p, again.select(pp.p1(again)).collect()))
    kept.unpersist()
