"""Model dataflow queries.  A fit has no SQL form; what follows from its scores has:
the builds publish their scores (``artifacts``), and the oracles compute metrics,
selection, blends and explanations from them and the given tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fround, fround_sql
from ..ml import candidates as fam
from ..ml import cv, enhanced, fitted
from ..ml import prepared as pp
from ..operators import blend as bl
from ..operators import evaluate as ev
from ..operators import policy as pol
from ..operators import profile as pr
from ..operators import split as sp
from ..session import materialize
from ..sources import digest, io
from ..sources.tables import read_csv, read_table
from .analysis_frame import analysis_frame
from .artifacts import over_artifacts, publish
from .data_queries import V2_EXPECT, _sql_clean_ctes, sql_v2_checks
from .fixtures import SQL_APPLICATIONS_V1, SQL_APPLICATIONS_V2_RAW, V2_PREDICTORS, applications_v1, applications_v2_raw
from .policy_queries import sql_policy_kpis_baseline

QUALITY = "fast"
V1_REPEATS = cv.REPEATS
V1_SIZES: dict = {}                  # no family is cut; tests set the name, nothing reads it
V2_TRIALS = enhanced.TRIALS[QUALITY]      # tests set the name, nothing reads it
AUDITED = ["gender", "education", "property_area"]
RATES = ("accuracy", "balanced_accuracy", "precision", "recall", "recall_0", "f1")


def _key(spark, sf_dir):
    return (spark.sparkContext.applicationId, sf_dir)


# ------------------------------------------------------------ metric SQL

def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


def metric_ctes(src: str, by: list[str], out: str, threshold: str = "0.5") -> str:
    """CTE ``out``: counts, rates, AUC (half credit for ties) of ``src`` (y, p) per group."""
    g = f"GROUP BY {', '.join(by)}" if by else ""
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    tied = ", ".join([*by, "p"])
    rec1, rec0, prec = _div("tp", "tp + fn"), _div("tn", "tn + fp"), _div("tp", "tp + fp")
    f1 = _div(f"2 * {prec} * {rec1}", f"{prec} + {rec1}")
    cols = ", ".join(by) + ", " if by else ""
    return f"""{out}_r AS (SELECT *, rank() OVER ({part} ORDER BY p) + (count(*) OVER (PARTITION BY {tied}) - 1) / 2.0 AS ar
  FROM {src}),
{out}_c AS (SELECT {cols}count_if(y = 0 AND p < {threshold}) AS tn, count_if(y = 0 AND p >= {threshold}) AS fp,
    count_if(y = 1 AND p < {threshold}) AS fn, count_if(y = 1 AND p >= {threshold}) AS tp,
    avg(pow(p - y, 2)) AS brier, sum(CASE WHEN y = 1 THEN ar ELSE 0 END) AS rs
  FROM {out}_r {g}),
{out} AS (SELECT {cols}tn, fp, fn, tp, brier, (tp + tn) / (tn + fp + fn + tp) AS accuracy,
    ({rec1} + {rec0}) / 2.0 AS balanced_accuracy, {prec} AS precision, {rec1} AS recall, {rec0} AS recall_0, {f1} AS f1,
    CASE WHEN tp + fn > 0 AND tn + fp > 0
         THEN (rs - (tp + fn) * (tp + fn + 1) / 2.0) / ((tp + fn) * (tn + fp)) END AS auc
  FROM {out}_c)"""


def _mean_std_sql(metrics) -> str:
    return ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in metrics)


# ------------------------------------------------------------ v1 build

@dataclass
class V1Build:
    train: DataFrame
    scores: DataFrame            # held rows of all repeats and folds
    champion: str
    preprocessing: PipelineModel
    members: dict                # champion and challenger, fitted on all rows


_TRAIN: dict = {}
_V1: dict = {}


def _train(spark, sf_dir) -> DataFrame:
    key = _key(spark, sf_dir)
    if key not in _TRAIN:
        _TRAIN[key] = materialize(lambda: cv.training_frame(spark, sf_dir), "training_frame", key, spark)
    return _TRAIN[key]


def _v1(spark, sf_dir) -> V1Build:
    """The v1 build of this session: all families in repeated folds, champion and challenger
    fitted, saved and loaded again."""
    key = _key(spark, sf_dir)
    if key not in _V1:
        train = _train(spark, sf_dir)
        scores = cv.held_scores(train, repeats=V1_REPEATS)
        name = cv.champion(cv.benchmark(scores))
        pre, members = cv.fit_pair(train, name)
        path = io.run_path(spark, "models/v1")
        pre.write().overwrite().save(f"{path}/preprocessing")
        for n, m in members.items():
            m.write().overwrite().save(f"{path}/{n}")
        pre = PipelineModel.load(f"{path}/preprocessing")
        members = {n: PipelineModel.load(f"{path}/{n}") for n in members}
        publish(scores, "v1_scores")
        publish(fitted.coefficient_table(spark, fitted.coefficients(pre, members[fam.CHALLENGER].stages[-1])),
                "v1_coefficients")
        publish(fitted.filled(train, pre).select("application_id", *cv_features()), "v1_filled")
        publish(fitted.encoded_importance(spark, pre, members[name].stages[-1]), "v1_importance")
        pair = pp.score(train, pre, members)
        publish(pair.select("application_id", F.lit(name).alias("champion"), F.col(f"p_{name}").alias("p"),
                            F.col(f"p_{fam.CHALLENGER}").alias("q")), "v1_pair")
        _V1[key] = V1Build(train, scores, name, pre, members)
    return _V1[key]


def cv_features() -> list[str]:
    from ..ml.preprocess import V1_CATEGORICAL, V1_NUMERIC
    return [*V1_NUMERIC, *V1_CATEGORICAL]


def _oof(spark, sf_dir) -> DataFrame:
    """Out-of-fold scores: the held rows of the first repeat."""
    return _v1(spark, sf_dir).scores.where("repeat = 0").drop("repeat")


def oof_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _oof(spark, sf_dir).select("application_id", "model", "fold", "y", F.round("p", 6).alias("p"))


def _sql_oof(scores: str) -> str:
    """Scores, with label and fold of the first repeat from the given tables."""
    key = f"('0x' || substr(md5(CAST(application_id AS VARCHAR) || ':{cv.FOLD_SEED}-0'), 1, 15))::BIGINT"
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT *, CAST(trim(loan_status) = 'Y' AS INTEGER) AS y FROM applications_v1),
folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {key}, application_id) - 1) % {cv.FOLDS} AS INTEGER)
          AS fold FROM lab),
models AS (SELECT unnest({fam.FAMILIES!r}) AS model),
scores AS (SELECT application_id, model, p FROM {scores} WHERE repeat = 0),
oof AS (SELECT f.*, m.model, s.p FROM folds f CROSS JOIN models m LEFT JOIN scores s USING (application_id, model))"""


def sql_oof_scores(scores: str) -> str:
    return _sql_oof(scores) + "\nSELECT application_id, model, fold, y, round(p, 6) AS p FROM oof"


V1_METRICS = ("accuracy", "balanced_accuracy", "auc", "f1", "recall", "recall_0")


def cv_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every family over all repeats and folds, best first."""
    b = cv.benchmark(_v1(spark, sf_dir).scores)
    return b.select("model", *[F.round(c, 6).alias(c) for c in b.columns if c != "model"]) \
            .orderBy(F.col("auc_mean").desc(), F.col("balanced_accuracy_mean").desc(), "model")


def sql_cv_benchmark(scores: str) -> str:
    return f"WITH s AS (SELECT * FROM {scores}), " + metric_ctes("s", ["model", "repeat", "fold"], "m") + f"""
SELECT model, {_mean_std_sql(V1_METRICS)} FROM m GROUP BY model HAVING count(*) = {V1_REPEATS * cv.FOLDS}"""


def _holdout(spark, sf_dir, family: str, name: str) -> DataFrame:
    scores = materialize(lambda: cv.holdout_scores(_train(spark, sf_dir), family), name, _key(spark, sf_dir), spark)
    publish(scores, name)
    m = cv.holdout_metrics(scores, family)
    return m.select("model", "tn", "fp", "fn", "tp", *[fround(c, 6).alias(c) for c in RATES],
                    F.round("auc", 6).alias("auc"), F.round("brier", 6).alias("brier"))


def _sql_holdout(family: str):
    def sql(scores: str) -> str:
        n = f"floor(n * {cv.TEST_SIZE} + 0.5)"
        key = sp.order_key_sql("application_id", cv.SPLIT_SEED)
        return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT application_id, CAST(trim(loan_status) = 'Y' AS INTEGER) AS y FROM applications_v1),
rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {key}, application_id) - 1 AS rn,
              count(*) OVER (PARTITION BY y) AS n FROM lab),
s AS (SELECT y, p FROM (SELECT application_id, y FROM rk WHERE rn < {n}) LEFT JOIN
      (SELECT application_id, p FROM {scores}) USING (application_id)),
""" + metric_ctes("s", [], "m") + f"""
SELECT '{family}' AS model, tn, fp, fn, tp, {", ".join(f"{fround_sql(c, 6)} AS {c}" for c in RATES)},
  round(auc, 6) AS auc, round(brier, 6) AS brier FROM m"""
    return sql


def holdout_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holdout(spark, sf_dir, "logistic_regression", "v1_holdout")


def holdout_eval_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout metrics of the kernel-SVM stand-in (random Fourier features)."""
    return _holdout(spark, sf_dir, "rbf_svm_standin", "v1_holdout_svm")


def fairness_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fairness slices of the out-of-fold scores of every family."""
    attrs = applications_v1(spark, sf_dir).select("application_id", *AUDITED)
    s = ev.fairness_slices(_oof(spark, sf_dir).join(attrs, "application_id"), "y", "p", AUDITED, by=["model"])
    return s.select("model", "attribute", "group", "n", *[F.round(c, 6).alias(c) for c in (
        "actual_rate", "predicted_rate", "mean_score")], *[fround(c, 6).alias(c) for c in (
            "balanced_accuracy", "recall", "recall_0")])


def sql_fairness_model(scores: str) -> str:
    parts = " UNION ALL ".join(f"""SELECT model, '{a}' AS attribute, coalesce({a}, 'Missing') AS "group", y, p FROM oof"""
                               for a in AUDITED)
    rec1, rec0 = _div("tp", "tp + fn"), _div("tn", "tn + fp")
    present = "CAST((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END) AS DOUBLE)"
    return _sql_oof(scores) + f""",
g AS (SELECT model, attribute, "group", count(*) AS n, avg(CAST(y AS DOUBLE)) AS a, avg(CAST(p >= 0.5 AS DOUBLE)) AS b,
        avg(p) AS c, count_if(y = 0 AND p < 0.5) AS tn, count_if(y = 0 AND p >= 0.5) AS fp,
        count_if(y = 1 AND p < 0.5) AS fn, count_if(y = 1 AND p >= 0.5) AS tp
      FROM ({parts}) GROUP BY ALL HAVING count(*) >= 10)
SELECT model, attribute, "group", n, round(a, 6) AS actual_rate, round(b, 6) AS predicted_rate, round(c, 6) AS mean_score,
  {fround_sql(f"({rec1} + {rec0}) / {present}", 6)} AS balanced_accuracy, {fround_sql(rec1, 6)} AS recall,
  {fround_sql(rec0, 6)} AS recall_0 FROM g"""


# ------------------------------------------------------------ fitted v1 models

def _table(spark, sf_dir) -> list[tuple]:
    b = _v1(spark, sf_dir)
    return fitted.coefficients(b.preprocessing, b.members[fam.CHALLENGER].stages[-1])


def fitted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every application scored by the coefficient table of the fitted logistic model."""
    p = fitted.probability(_table(spark, sf_dir))
    x = fitted.filled(_train(spark, sf_dir), _v1(spark, sf_dir).preprocessing)
    return x.select("application_id", F.round(p, 6).alias("approval_probability"), (p >= 0.5).alias("approved"))


def _sql_terms(coefficients: str, filled: str) -> str:
    """CTE ``terms``: (application_id, feature, c), coefficient times encoded value."""
    from ..ml.preprocess import V1_CATEGORICAL, V1_NUMERIC
    return f"""WITH coef AS (SELECT * FROM {coefficients}), x AS (SELECT * FROM {filled}),
nums AS (SELECT application_id, feature, v FROM (UNPIVOT x ON {", ".join(V1_NUMERIC)} INTO NAME feature VALUE v)),
cats AS (SELECT application_id, feature, v FROM (UNPIVOT x ON {", ".join(V1_CATEGORICAL)} INTO NAME feature VALUE v)),
terms AS (
  SELECT application_id, feature, coefficient * ((v - mean) / deviation) AS c FROM nums JOIN coef USING (feature)
  UNION ALL SELECT application_id, feature, coalesce(coefficient, 0.0) FROM cats
  LEFT JOIN coef USING (feature) WHERE coef.level = cats.v
  UNION ALL SELECT application_id, feature, 0.0 FROM cats
  WHERE NOT EXISTS (SELECT 1 FROM coef WHERE coef.feature = cats.feature AND coef.level = cats.v))"""


def sql_fitted_scores(coefficients: str, filled: str) -> str:
    return _sql_terms(coefficients, filled) + f""",
z AS (SELECT application_id, 1.0 / (1.0 + exp(-(sum(c) + (SELECT coefficient FROM coef WHERE feature = '{fitted.INTERCEPT}'))))
        AS p FROM terms GROUP BY 1)
SELECT application_id, round(p, 6) AS approval_probability, p >= 0.5 AS approved FROM z"""


def fitted_score_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on which the coefficient table and the model itself differ by more than 1e-9."""
    b, t = _v1(spark, sf_dir), _train(spark, sf_dir)
    p = fitted.probability(_table(spark, sf_dir))
    mine = fitted.filled(t, b.preprocessing).select("application_id", p.alias("a"))
    theirs = pp.score(t, b.preprocessing, {"m": b.members[fam.CHALLENGER]}).select("application_id", F.col("p_m").alias("b"))
    return mine.join(theirs, "application_id").agg(F.count(F.lit(1)).alias("rows"),
                                                   F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-9).alias("differing"))


def sql_fitted_score_check() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + "\nSELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM applications_v1"


def fitted_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = fitted.filled(_train(spark, sf_dir), _v1(spark, sf_dir).preprocessing)
    return fitted.factors(x, _table(spark, sf_dir), "application_id")


def sql_fitted_factors(coefficients: str, filled: str) -> str:
    labels = " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in fitted.LABELS.items())
    return _sql_terms(coefficients, filled) + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY abs(round(c, 9)) DESC, feature) AS rank FROM terms)
SELECT application_id, rank, feature, CASE feature {labels} ELSE feature END AS label, round(c, 6) + 0.0 AS contribution,
  CASE WHEN c >= 0 THEN 'supports approval' ELSE 'reduces approval' END AS direction FROM r WHERE rank <= 6"""


def fitted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champion and challenger of the build on every application, scored in one pass."""
    b = _v1(spark, sf_dir)
    p, q = F.col(f"p_{b.champion}"), F.col(f"p_{fam.CHALLENGER}")
    ok = p >= 0.5
    return pp.score(_train(spark, sf_dir), b.preprocessing, b.members).select(
        "application_id", ok.alias("likely_approved"), F.round(p, 6).alias("approval_probability"),
        F.round(1 - p, 6).alias("rejection_probability"), F.round(F.when(ok, p).otherwise(1 - p), 6).alias("confidence"),
        F.lit(b.champion).alias("champion_model"), F.lit(fam.CHALLENGER).alias("challenger_model"),
        F.round(q, 6).alias("challenger_probability"), (ok == (q >= 0.5)).alias("models_agree"))


def sql_fitted_predictions(pair: str) -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + f"""
SELECT application_id, p >= 0.5 AS likely_approved, round(p, 6) AS approval_probability,
  round(1 - p, 6) AS rejection_probability, round(CASE WHEN p >= 0.5 THEN p ELSE 1 - p END, 6) AS confidence,
  champion AS champion_model, '{fam.CHALLENGER}' AS challenger_model, round(q, 6) AS challenger_probability,
  (p >= 0.5) = (q >= 0.5) AS models_agree
FROM applications_v1 LEFT JOIN {pair} USING (application_id)"""


def fitted_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every coefficient of the logistic model, with its share."""
    b = _v1(spark, sf_dir)
    e = fitted.encoded_importance(spark, b.preprocessing, b.members[fam.CHALLENGER].stages[-1])
    return _rounded(fitted.with_share(e, "encoded"), "encoded")


def _rounded(importance: DataFrame, name: str) -> DataFrame:
    return importance.select(name, F.round("importance", 6).alias("importance"), F.round("share", 6).alias("share"))


def sql_fitted_importance(coefficients: str) -> str:
    return f"""WITH c AS (SELECT feature || coalesce('=' || level, '') AS encoded, abs(coefficient) AS v
  FROM {coefficients} WHERE feature <> '{fitted.INTERCEPT}')
SELECT encoded, round(v, 6) AS importance, round(v / (SELECT sum(v) FROM c), 6) AS share FROM c"""


def champion_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The champion's tree importances, rolled up to base features."""
    b = _v1(spark, sf_dir)
    e = fitted.encoded_importance(spark, b.preprocessing, b.members[b.champion].stages[-1])
    return _rounded(fitted.rolled_up(e), "feature")


def sql_champion_importance(encoded: str) -> str:
    return f"""WITH g AS (SELECT split_part(encoded, '=', 1) AS feature, sum(importance) AS v FROM {encoded} GROUP BY 1)
SELECT feature, round(v, 6) AS importance, round(v / (SELECT sum(v) FROM g), 6) AS share FROM g"""


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, and re-score: loaded and fitted models agree."""
    t = _train(spark, sf_dir)
    split = pp.prepare(t, cv.v1_stages(), F.col("split") == "test", "application_id")
    model = pp.fit_all(split, {"m": ("logistic_regression", None)}, ["m"], fam.estimators)["m"]
    path = io.run_path(spark, "models/logistic")
    split.model.write().overwrite().save(f"{path}/preprocessing")
    model.write().overwrite().save(f"{path}/model")
    loaded = PipelineModel.load(f"{path}/preprocessing"), {"m": PipelineModel.load(f"{path}/model")}
    test = t.where("split = 'test'")
    a = pp.score(test, split.model, {"m": model}).select("application_id", F.col("p_m").alias("p_fit"))
    b = pp.score(test, *loaded).select("application_id", F.col("p_m").alias("p_loaded"))
    return a.join(b, "application_id").agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.max(F.abs(F.col("p_fit") - F.col("p_loaded"))).alias("max_abs_diff"))


def sql_model_roundtrip() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT trim(loan_status) = 'Y' AS y, count(*) AS n FROM applications_v1 GROUP BY 1)
SELECT CAST(sum(floor(n * {cv.TEST_SIZE} + 0.5)) AS BIGINT) AS rows_scored, CAST(0.0 AS DOUBLE) AS max_abs_diff FROM lab"""


# ------------------------------------------------------------ reports and publication

def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy KPI report written as JSON to the shared folder and read back."""
    k = pol.policy_metrics(analysis_frame(spark, sf_dir), 0.75, 0.25)
    path = io.run_path(spark, "reports/policy_kpis")
    io.write_json(k, path)
    return io.read_json(spark, path, k.schema)


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned v2 table staged, checked, published only if clean."""
    from ..operators import clean as cl
    from ..operators import validate as va
    df = cl.normalize(applications_v2_raw(spark, sf_dir))
    return io.staged_publish(df, io.run_path(spark, "staging/v2"), io.run_path(spark, "published/v2"),
                             lambda staged: va.dataset_checks(staged, V2_EXPECT))


def sql_staged_publish() -> str:
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f""",
checks AS ({sql_v2_checks()})
SELECT *, CASE WHEN (SELECT bool_and(passed) FROM checks) THEN 'published' ELSE 'rejected' END AS status FROM checks"""


RUN_MEMBERS = {"champion": 0.5, "challenger": 0.5}


def run_record(spark: SparkSession, sf_dir: str, run: int, weights: dict) -> DataFrame:
    """What a run is known by: rows, split sizes, seeds, members with weights, threshold, digest of
    the training rows (every column), time."""
    t = _train(spark, sf_dir)
    sizes = t.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("split") == "dev").alias("dev_rows"),
                  F.count_if(F.col("split") == "test").alias("test_rows"))
    a = applications_v1(spark, sf_dir)
    fp = pr.row_fingerprint(a.select(*RUN_COLUMNS), RUN_COLUMNS)
    members = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(float(w)).alias("weight")) for n, w in weights.items()])
    return sizes.crossJoin(fp.select(F.col("hash_sum").alias("source_fingerprint"))).select(
        F.lit(run).alias("run"), "*", F.lit(cv.SPLIT_SEED).alias("split_seed"), F.lit(cv.FOLD_SEED).alias("fold_seed"),
        members.alias("members"), F.lit(0.5).alias("threshold"), F.current_timestamp().alias("created_at"),
        F.date_format(F.current_timestamp(), "yyyy.MM.dd").alias("model_version"))


# text and key columns: numbers print alike in every engine only as whole numbers
RUN_COLUMNS = ["application_id", "gender", "married", "dependents", "education", "self_employed", "property_area",
               "loan_status"]


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one log, which is read back with a row per run and member (without times)."""
    log = io.run_path(spark, "run_log")
    for run, weights in enumerate((RUN_MEMBERS, {"champion": 1.0})):
        io.append_run(run_record(spark, sf_dir, run, weights), log)
    return (io.read_runs(spark, log).select("*", F.explode("members").alias("m"))
            .select("run", "rows", "dev_rows", "test_rows", "source_fingerprint", "split_seed", "fold_seed", "threshold",
                    "m.model", "m.weight"))


def sql_run_metadata() -> str:
    text = pr.canonical_sql([f"CAST({c} AS VARCHAR)" for c in RUN_COLUMNS])
    n = f"floor(n * {cv.TEST_SIZE} + 0.5)"
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT trim(loan_status) = 'Y' AS y, count(*) AS n FROM applications_v1 GROUP BY 1),
runs AS (SELECT * FROM (VALUES (0, 'champion', 0.5::DOUBLE), (0, 'challenger', 0.5::DOUBLE), (1, 'champion', 1.0::DOUBLE))
         AS r(run, model, weight))
SELECT run, (SELECT count(*) FROM applications_v1) AS rows, (SELECT CAST(sum(n - {n}) AS BIGINT) FROM lab) AS dev_rows,
  (SELECT CAST(sum({n}) AS BIGINT) FROM lab) AS test_rows,
  (SELECT CAST(sum(('0x' || substr(md5({text}), 1, 15))::HUGEINT) AS VARCHAR) FROM applications_v1) AS source_fingerprint,
  {cv.SPLIT_SEED} AS split_seed, {cv.FOLD_SEED} AS fold_seed, CAST(0.5 AS DOUBLE) AS threshold, model, weight FROM runs"""


FINGERPRINT_TABLES = {"customer": ["c_custkey", "c_nationkey", "c_mktsegment"],
                      "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey"]}


def file_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of source tables: rows and an order-free sum of row hashes,
    whatever their files and partitions (no file is held as one value)."""
    out = None
    for name, cols in FINGERPRINT_TABLES.items():
        one = pr.row_fingerprint(read_table(spark, sf_dir, name).select(*cols), cols).select(
            F.lit(name).alias("table"), "rows", "hash_sum")
        out = one if out is None else out.unionByName(one)
    return out


DIGEST_TABLES = ["orders", "customer", "part", "supplier"]


def file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the bytes of the files of source tables."""
    out = None
    for name in DIGEST_TABLES:
        one = digest.file_digests(spark, f"{sf_dir.rstrip('/')}/{name}.parquet").withColumn("table", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def sql_file_fingerprint() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "table", count(*) AS rows,
  CAST(sum(('0x' || substr(md5({pr.canonical_sql([f"CAST({c} AS VARCHAR)" for c in cols])}), 1, 15))::HUGEINT) AS VARCHAR)
    AS hash_sum FROM {name}""" for name, cols in FINGERPRINT_TABLES.items())


# ------------------------------------------------------------ v2 build

@dataclass
class V2Build:
    train: DataFrame
    scores: DataFrame            # out-of-fold, untuned candidates and all trials
    trials: dict
    tuning: DataFrame
    oof: DataFrame               # out-of-fold, a family's best trial under the family's name
    names: list[str]             # finalists
    blend: object                # row of weights, threshold and metrics
    bundle: enhanced.Bundle      # saved and loaded again
    fitted: enhanced.Bundle


_V2: dict = {}


def _v2(spark, sf_dir) -> V2Build:
    """The v2 build of this session: untuned candidates and trials on the same prepared folds,
    finalists, blend, members fitted on all development rows, the bundle saved and loaded."""
    key = _key(spark, sf_dir)
    if key not in _V2:
        train = materialize(lambda: enhanced.training_frame(spark, sf_dir, QUALITY), "v2_training", key, spark)
        trials = enhanced.trial_candidates(quality=QUALITY)
        scores = enhanced.out_of_fold(enhanced.prepared_folds(train, QUALITY),
                                      {**enhanced.with_tuned(None), **trials}, QUALITY)
        tuning = materialize(enhanced.tuning_table(scores, trials), "v2_tuning", key)
        named = {r["model"]: f"{r['model']}#{r['trial']}" for r in tuning.where("best").collect()}
        named = {f: named.get(f, f) for f in enhanced.FAMILIES}
        family = F.coalesce(*[F.when(F.col("model") == n, F.lit(f)) for f, n in named.items()])
        oof = materialize(scores.withColumn("model", family).where("model IS NOT NULL"), "v2_oof", key)
        names = enhanced.finalists(oof)
        chosen = materialize(enhanced.blend(oof, names), "v2_blend", key).first()
        weights = [chosen[f"w{i + 1}"] for i in range(len(names))]
        made = enhanced.fit_bundle(train, enhanced.with_tuned(tuning), names, weights, chosen["threshold"],
                                   {"seed": enhanced.SEED, "quality": QUALITY, "members": names}, QUALITY)
        path = io.run_path(spark, "bundles/v2")
        enhanced.save_bundle(spark, path, made)
        publish(scores, "v2_scores")
        publish(spark.createDataFrame([(f, i, json.dumps(p, sort_keys=True)) for f, i, p in (
            (f, int(n.split("#")[1]), p) for n, (f, p) in trials.items())], "model string, trial int, params string"),
            "v2_trials")
        publish(spark.createDataFrame([(i + 1, n, float(w), float(chosen["threshold"])) for i, (n, w) in enumerate(
            zip(names, weights))], "position int, model string, weight double, threshold double"), "v2_members")
        _V2[key] = V2Build(train, scores, trials, tuning, oof, names, chosen, enhanced.load_bundle(spark, path), made)
    return _V2[key]


def member_rows(scored: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """Long form of member scores: (keep..., model, p)."""
    return scored.select(*keep, F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("p"))
                                                    for n in names])).alias("m")).select(*keep, "m.*")


def _scored_once(spark, sf_dir, name: str, make, *keep: str) -> DataFrame:
    """Scored variants, written once, their member scores published."""
    def build():
        out = make(_v2(spark, sf_dir))
        return out

    scored = materialize(build, name, _key(spark, sf_dir), spark)
    publish(member_rows(scored, _v2(spark, sf_dir).names, *keep), name)
    return scored


def v2_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _v2(spark, sf_dir).tuning
    return t.select("model", "trial", "params", F.round("cv_accuracy", 6).alias("cv_accuracy"),
                    F.round("cv_auc", 6).alias("cv_auc"), "best")


def _sql_tuning(scores: str, trials: str) -> str:
    return f"WITH s AS (SELECT * FROM {scores}), " + metric_ctes("s", ["model", "fold"], "m") + f""",
b AS (SELECT split_part(model, '#', 1) AS model, CAST(split_part(model, '#', 2) AS INTEGER) AS trial,
        avg(accuracy) AS cv_accuracy, avg(auc) AS cv_auc FROM m WHERE contains(model, '#') GROUP BY ALL),
tuning AS (SELECT t.*, b.cv_accuracy, b.cv_auc,
        row_number() OVER (PARTITION BY t.model ORDER BY b.cv_accuracy DESC, t.trial) = 1 AS best
      FROM {trials} t LEFT JOIN b USING (model, trial))"""


def sql_v2_tuning(scores: str, trials: str) -> str:
    return _sql_tuning(scores, trials) + """
SELECT model, trial, params, round(cv_accuracy, 6) AS cv_accuracy, round(cv_auc, 6) AS cv_auc, best FROM tuning"""


def tuned_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best trial of every tuned family."""
    return v2_tuning(spark, sf_dir).where("best").drop("best").orderBy(F.col("cv_accuracy").desc(), "model")


def sql_tuned_search(scores: str, trials: str) -> str:
    return _sql_tuning(scores, trials) + """
SELECT model, trial, params, round(cv_accuracy, 6) AS cv_accuracy, round(cv_auc, 6) AS cv_auc FROM tuning WHERE best"""


def v2_oof_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v2(spark, sf_dir).oof.select("loan_id", "model", "fold", "y", F.round("p", 6).alias("p"))


def _sql_v2_rows() -> str:
    """CTE ``v2rows``: loan_id, y, split, fold of the cleaned rows."""
    def key(seed):
        return sp.order_key_sql("loan_id", seed)
    n = f"floor(n * {enhanced.TEST_SIZE} + 0.5)"
    return SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f""",
v2r AS (SELECT loan_id, CAST(target AS INTEGER) AS y, row_number() OVER (PARTITION BY target
          ORDER BY {key(enhanced.SEED)}, loan_id) - 1 AS rn, count(*) OVER (PARTITION BY target) AS n
        FROM clean WHERE target IS NOT NULL),
v2rows AS (SELECT loan_id, y, CASE WHEN rn < {n} THEN 'test' ELSE 'dev' END AS split,
    CASE WHEN rn >= {n} THEN CAST((row_number() OVER (PARTITION BY y, rn >= {n} ORDER BY {key(enhanced.SEED)}, loan_id) - 1)
      % {enhanced.FOLDS[QUALITY]} AS INTEGER) END AS fold FROM v2r)"""


def _sql_v2_oof(scores: str, trials: str) -> str:
    """CTE ``oof``: rows, labels and folds from the given tables, scores of the untuned linear
    model and of the best trial of the other families."""
    return _sql_tuning(scores, trials) + ", " + _sql_v2_rows() + f""",
chosen AS (SELECT model || '#' || trial AS name, model FROM tuning WHERE best
           UNION ALL SELECT 'logistic_regression', 'logistic_regression'),
oof AS (SELECT r.loan_id, c.model, r.fold, r.y, s.p FROM v2rows r CROSS JOIN chosen c
        LEFT JOIN s ON s.loan_id = r.loan_id AND s.model = c.name WHERE r.split = 'dev')"""


def sql_v2_oof_scores(scores: str, trials: str) -> str:
    return _sql_v2_oof(scores, trials) + "\nSELECT loan_id, model, fold, y, round(p, 6) AS p FROM oof"


V2_METRICS = ("accuracy", "balanced_accuracy", "auc", "f1")


def v2_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untuned candidates, best first: by mean accuracy, then AUC."""
    b = enhanced.benchmark(_v2(spark, sf_dir).scores.where(~F.col("model").contains("#")))
    return b.select("model", *[F.round(c, 6).alias(c) for c in b.columns if c != "model"])


def sql_v2_benchmark(scores: str) -> str:
    return f"WITH s AS (SELECT * FROM {scores} WHERE NOT contains(model, '#')), " + metric_ctes(
        "s", ["model", "fold"], "m") + f"\nSELECT model, {_mean_std_sql(V2_METRICS)} FROM m GROUP BY model"


def v2_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finalists with their weights, and threshold and out-of-fold metrics of the blend."""
    b = _v2(spark, sf_dir)
    rows = [(i + 1, n, b.blend[f"w{i + 1}"], b.blend["threshold"], b.blend["accuracy"], b.blend["balanced_accuracy"],
             b.blend["auc"]) for i, n in enumerate(b.names)]
    out = spark.createDataFrame(rows, "position int, model string, weight double, threshold double, accuracy double, "
                                      "balanced_accuracy double, auc double")
    return out.select("position", "model", "weight", "threshold", *[fround(c, 9).alias(c) for c in (
        "accuracy", "balanced_accuracy", "auc")])


def sql_v2_blend(scores: str, trials: str) -> str:
    """Finalists by their order, then every weight vector at every threshold."""
    k = enhanced.FINALISTS
    grid = bl.weight_grid(k)
    values = ", ".join(f"({i}, [" + ", ".join(f"{x / bl.WEIGHT_STEPS!r}::DOUBLE" for x in ks) + "])" for i, ks in enumerate(grid))
    thresholds = ", ".join(f"({j}, {t!r}::DOUBLE)" for j, t in enumerate(bl.THRESHOLDS))
    blended = " + ".join(f"w[{i + 1}] * p{i + 1}" for i in range(k))
    wide = ", ".join(f"max(CASE WHEN position = {i + 1} THEN p END) AS p{i + 1}" for i in range(k))
    rec1, rec0 = _div("tp", "tp + fn"), _div("tn", "tn + fp")
    return _sql_v2_oof(scores, trials) + ", " + metric_ctes("oof", ["model"], "single") + f""",
ranked AS (SELECT model, row_number() OVER (ORDER BY accuracy DESC, balanced_accuracy DESC, auc DESC, model) AS position
           FROM single),
names AS (SELECT * FROM ranked WHERE position <= {k}),
wide AS (SELECT loan_id, y, {wide} FROM oof JOIN names USING (model) GROUP BY loan_id, y),
w AS (SELECT * FROM (VALUES {values}) AS t(wid, w)),
th AS (SELECT * FROM (VALUES {thresholds}) AS t(j, threshold)),
bp AS (SELECT wid, y, {blended} AS p FROM wide CROSS JOIN w),
cnt AS (SELECT wid, j, threshold, count_if(y = 1 AND p >= threshold) AS tp, count_if(y = 0 AND p < threshold) AS tn,
               count_if(y = 1 AND p < threshold) AS fn, count_if(y = 0 AND p >= threshold) AS fp
        FROM bp CROSS JOIN th GROUP BY 1, 2, 3),
mm AS (SELECT wid, j, threshold, (tp + tn) / (tp + tn + fp + fn) AS accuracy, ({rec1} + {rec0}) / 2.0 AS balanced_accuracy
       FROM cnt),
top AS (SELECT max({{'a': accuracy, 'b': balanced_accuracy}}) AS b FROM mm),
tied AS (SELECT mm.* FROM mm, top WHERE accuracy = b.a AND balanced_accuracy = b.b),
ar AS (SELECT wid, y, rank() OVER (PARTITION BY wid ORDER BY p) + (count(*) OVER (PARTITION BY wid, p) - 1) / 2.0 AS r
       FROM bp WHERE wid IN (SELECT wid FROM tied)),
au AS (SELECT wid, (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * count_if(y = 0)) AS auc FROM ar GROUP BY wid),
pick AS (SELECT tied.*, au.auc FROM tied JOIN au USING (wid)
         ORDER BY auc DESC, abs(threshold - 0.5) ASC, wid ASC, j ASC LIMIT 1)
SELECT CAST(n.position AS INTEGER) AS position, n.model, w.w[n.position] AS weight, threshold,
  {fround_sql("accuracy", 9)} AS accuracy, {fround_sql("balanced_accuracy", 9)} AS balanced_accuracy,
  {fround_sql("auc", 9)} AS auc
FROM pick JOIN w USING (wid) CROSS JOIN names n"""


def _v2_holdout_scores(spark, sf_dir) -> DataFrame:
    return _scored_once(spark, sf_dir, "v2_holdout", lambda b: enhanced.ensemble_scores(
        b.train.where("split = 'test'"), b.bundle).drop(*V2_PREDICTORS), "loan_id", "label")


def v2_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blend on the untouched holdout, and every member for diagnosis."""
    b = _v2(spark, sf_dir)
    m = enhanced.holdout_metrics(_v2_holdout_scores(spark, sf_dir), b.names, b.bundle.threshold)
    return m.select("model", "tn", "fp", "fn", "tp", *[fround(c, 6).alias(c) for c in RATES],
                    F.round("auc", 6).alias("auc"))


def _sql_ensemble(scores: str, members: str, by: str) -> str:
    """CTE ``ens``: weighted mean of member scores in blend order, and the threshold."""
    return f"""sc AS (SELECT * FROM {scores}), mb AS (SELECT * FROM {members}),
ens AS (SELECT {by}, list_sum(list(weight * p ORDER BY position)) AS p, max(threshold) AS threshold,
          list({{'model': model, 'weight': weight, 'p': p}} ORDER BY position) AS members
        FROM sc JOIN mb USING (model) GROUP BY {by})"""


def sql_v2_holdout(scores: str, members: str) -> str:
    return "WITH " + _sql_v2_rows() + ", " + _sql_ensemble(scores, members, "loan_id") + """,
t AS (SELECT loan_id, y FROM v2rows WHERE split = 'test'),
lm AS (SELECT 'ensemble' AS model, y, p, threshold FROM t LEFT JOIN ens USING (loan_id)
       UNION ALL SELECT mb.model, y, sc.p, 0.5 FROM t CROSS JOIN mb LEFT JOIN sc USING (loan_id, model)),
""" + metric_ctes("lm", ["model", "threshold"], "m", "threshold") + f"""
SELECT model, tn, fp, fn, tp, {", ".join(f"{fround_sql(c, 6)} AS {c}" for c in RATES)}, round(auc, 6) AS auc FROM m"""


def v2_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holdout scored by the bundle as loaded and as fitted."""
    b = _v2(spark, sf_dir)
    again = enhanced.ensemble_scores(b.train.where("split = 'test'"), b.fitted).select("loan_id", F.col("p").alias("q"))
    d = _v2_holdout_scores(spark, sf_dir).join(again, "loan_id").agg(
        F.count(F.lit(1)).alias("rows_scored"), F.count_if(F.abs(F.col("p") - F.col("q")) > 1e-12).alias("differing"))
    same = all(getattr(b.bundle, k) == getattr(b.fitted, k) for k in ("weights", "threshold", "baselines", "metadata"))
    return d.select("*", F.lit(len(b.bundle.baselines)).cast("long").alias("baselines"),
                    F.lit(same and list(b.bundle.members) == b.names).alias("same_members"))


def sql_v2_bundle() -> str:
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f""",
lab AS (SELECT target, count(*) AS n FROM clean WHERE target IS NOT NULL GROUP BY 1)
SELECT CAST(sum(floor(n * {enhanced.TEST_SIZE} + 0.5)) AS BIGINT) AS rows_scored, CAST(0 AS BIGINT) AS differing,
  CAST(11 AS BIGINT) AS baselines, true AS same_members FROM lab"""


# ------------------------------------------------------------ scoring with the saved bundle

def bundle_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaned applications scored by the saved bundle: decision, probabilities, confidence
    and the members' scores."""
    b = _v2(spark, sf_dir)
    scored = _scored_once(spark, sf_dir, "v2_scored", lambda b: enhanced.ensemble_scores(
        b.train.select("loan_id", *V2_PREDICTORS), b.bundle).drop(*V2_PREDICTORS), "loan_id")
    p = enhanced.predictions(b.train.select("loan_id", *V2_PREDICTORS), b.bundle, scored)
    members = F.transform("ensemble_members", lambda m: F.concat_ws(
        ":", m["model"], F.format_string("%.4f", m["weight"]), F.format_string("%.6f", m["approval_probability"])))
    return p.withColumn("ensemble_members", F.concat_ws(";", members))


def sql_bundle_scores(scores: str, members: str) -> str:
    return "WITH " + _sql_v2_rows() + ", " + _sql_ensemble(scores, members, "loan_id") + """
SELECT loan_id, p >= threshold AS likely_approved, round(p, 6) AS approval_probability,
  round(1 - p, 6) AS rejection_probability, round(CASE WHEN p >= threshold THEN p ELSE 1 - p END, 6) AS confidence,
  threshold, array_to_string(list_transform(members, lambda m: m.model || ':' || format('{:.4f}', round(m.weight, 4)) || ':'
    || format('{:.6f}', round(m.p, 6))), ';') AS ensemble_members
FROM v2rows LEFT JOIN ens USING (loan_id)"""


def bundle_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top six predictors of every holdout application by the change of the ensemble's score
    when one is set to its baseline."""
    return enhanced.sensitivity(_scored_once(spark, sf_dir, "v2_sensitivity", lambda b: enhanced.sensitivity_scores(
        b.train.where("split = 'test'"), b.bundle), "loan_id", "feature"))


def sql_bundle_sensitivity(scores: str, members: str) -> str:
    labels = " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in enhanced.LABELS.items())
    return "WITH " + _sql_v2_rows() + ", " + _sql_ensemble(scores, members, "loan_id, feature") + f""",
x AS (SELECT r.loan_id, f.feature, e.p FROM v2rows r
      CROSS JOIN (SELECT unnest({list(V2_PREDICTORS)!r}) AS feature) f
      LEFT JOIN ens e ON e.loan_id = r.loan_id AND e.feature = f.feature WHERE r.split = 'test'),
d AS (SELECT x.loan_id, x.feature, round(b.p - x.p, 6) + 0.0 AS c
      FROM x LEFT JOIN ens b ON b.loan_id = x.loan_id AND b.feature = '{enhanced.BASE}'),
r AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY abs(c) DESC, feature) AS rank FROM d)
SELECT loan_id, rank, feature, CASE feature {labels} ELSE feature END AS label, c AS contribution,
  CASE WHEN c >= 0 THEN 'supports approval' ELSE 'reduces approval' END AS direction FROM r WHERE rank <= 6"""


def bundle_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permutation importance of every raw predictor for the ensemble on the holdout."""
    b = _v2(spark, sf_dir)
    scored = _scored_once(spark, sf_dir, "v2_permutations", lambda b: enhanced.permutation_scores(
        b.train.where("split = 'test'"), b.bundle, enhanced.REPEATS[QUALITY]), "loan_id", "label", "feature", "repeat")
    return enhanced.permutation_importance(scored, b.bundle.threshold)


def sql_bundle_importance(scores: str, members: str) -> str:
    return "WITH " + _sql_v2_rows() + ", " + _sql_ensemble(scores, members, "loan_id, feature, repeat") + f""",
acc AS (SELECT feature, repeat, avg(CAST(CAST(p >= threshold AS INTEGER) = y AS DOUBLE)) AS acc
        FROM v2rows JOIN ens USING (loan_id) WHERE split = 'test' GROUP BY ALL
        HAVING count(*) = (SELECT count(*) FROM v2rows WHERE split = 'test')),
d AS (SELECT feature, (SELECT acc FROM acc WHERE feature = '{enhanced.BASE}') - acc AS drop FROM acc
      WHERE feature <> '{enhanced.BASE}')
SELECT feature, round(avg(drop), 6) + 0.0 AS importance, round(stddev_pop(drop), 6) + 0.0 AS std FROM d
GROUP BY feature HAVING count(*) = {enhanced.REPEATS[QUALITY]}"""


def member_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every encoded column for every member of the bundle, with its share."""
    b = _v2(spark, sf_dir)
    out = None
    for n, m in b.bundle.members.items():
        one = fitted.encoded_importance(spark, b.bundle.preprocessing, m.stages[-1]).withColumn("model", F.lit(n))
        out = one if out is None else out.unionByName(one)
    out = materialize(out, "v2_importance", _key(spark, sf_dir))
    publish(out, "v2_importance")
    total = out.groupBy("model").agg(F.sum("importance").alias("t"))
    return out.join(F.broadcast(total), "model").select(
        "model", "encoded", F.round("importance", 6).alias("importance"),
        F.round(F.col("importance") / F.when(F.col("t") == 0, 1.0).otherwise(F.col("t")), 6).alias("share"))


def sql_member_importance(importance: str) -> str:
    return f"""SELECT model, encoded, round(importance, 6) AS importance,
  round(importance / sum(importance) OVER (PARTITION BY model), 6) AS share FROM {importance}"""


V1_CSV_SCHEMA = ("application_id bigint, gender string, married string, dependents string, education string, "
                 "self_employed string, applicant_income double, coapplicant_income double, loan_amount double, "
                 "loan_amount_term double, credit_history double, property_area string, loan_status string")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The v1 table written as CSV with a header and read back with the
    explicit schema: rows, nulls of every column, and rows that differ in any
    value from what was written."""
    a = applications_v1(spark, sf_dir)
    path = io.run_path(spark, "csv/applications_v1")
    a.write.mode("overwrite").option("header", True).csv(path)
    back = read_csv(spark, path, V1_CSV_SCHEMA)
    key = a.columns[0]
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in a.columns]
    differing = a.alias("a").join(back.alias("b"), key, "full").agg(
        F.count_if(~F.forall(F.array(*same), lambda x: x)).alias("differing_rows"))
    return back.agg(F.count(F.lit(1)).alias("rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in back.columns]).crossJoin(differing)


def sql_csv_roundtrip() -> str:
    cols = [c.split()[0] for c in V1_CSV_SCHEMA.split(", ")]
    return "WITH " + SQL_APPLICATIONS_V1 + "\nSELECT count(*) AS rows, " + ", ".join(
        f"count_if({c} IS NULL) AS null_{c}" for c in cols) + ", CAST(0 AS BIGINT) AS differing_rows FROM applications_v1"



V1, V2 = "v1_scores", ("v2_scores", "v2_trials")

QUERIES = {
    "oof_scores": (oof_scores, over_artifacts(sql_oof_scores, V1)),
    "cv_benchmark": (cv_benchmark, over_artifacts(sql_cv_benchmark, V1)),
    "holdout_eval": (holdout_eval, over_artifacts(_sql_holdout("logistic_regression"), "v1_holdout")),
    "holdout_eval_svm": (holdout_eval_svm, over_artifacts(_sql_holdout("rbf_svm_standin"), "v1_holdout_svm")),
    "fairness_model": (fairness_model, over_artifacts(sql_fairness_model, V1)),
    "json_roundtrip": (json_roundtrip, sql_policy_kpis_baseline),
    "csv_roundtrip": (csv_roundtrip, sql_csv_roundtrip),
    "model_roundtrip": (model_roundtrip, sql_model_roundtrip),
    "staged_publish": (staged_publish, sql_staged_publish),
    "run_metadata": (run_metadata, sql_run_metadata),
    "file_fingerprint": (file_fingerprint, sql_file_fingerprint),
    "file_digest": (file_digest, None),
    "fitted_scores": (fitted_scores, over_artifacts(sql_fitted_scores, "v1_coefficients", "v1_filled")),
    "fitted_score_check": (fitted_score_check, sql_fitted_score_check),
    "fitted_factors": (fitted_factors, over_artifacts(sql_fitted_factors, "v1_coefficients", "v1_filled")),
    "fitted_predictions": (fitted_predictions, over_artifacts(sql_fitted_predictions, "v1_pair")),
    "fitted_importance": (fitted_importance, over_artifacts(sql_fitted_importance, "v1_coefficients")),
    "champion_importance": (champion_importance, over_artifacts(sql_champion_importance, "v1_importance")),
    "v2_tuning": (v2_tuning, over_artifacts(sql_v2_tuning, *V2)),
    "tuned_search": (tuned_search, over_artifacts(sql_tuned_search, *V2)),
    "v2_oof_scores": (v2_oof_scores, over_artifacts(sql_v2_oof_scores, *V2)),
    "v2_benchmark": (v2_benchmark, over_artifacts(sql_v2_benchmark, "v2_scores")),
    "v2_blend": (v2_blend, over_artifacts(sql_v2_blend, *V2)),
    "v2_holdout": (v2_holdout, over_artifacts(sql_v2_holdout, "v2_holdout", "v2_members")),
    "v2_bundle": (v2_bundle, sql_v2_bundle),
    "bundle_scores": (bundle_scores, over_artifacts(sql_bundle_scores, "v2_scored", "v2_members")),
    "bundle_sensitivity": (bundle_sensitivity, over_artifacts(sql_bundle_sensitivity, "v2_sensitivity", "v2_members")),
    "bundle_importance": (bundle_importance, over_artifacts(sql_bundle_importance, "v2_permutations", "v2_members")),
    "member_importance": (member_importance, over_artifacts(sql_member_importance, "v2_importance")),
}
