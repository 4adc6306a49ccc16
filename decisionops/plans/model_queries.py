"""Enrichment, split, metric, fairness and baseline queries (Spark + DuckDB).

Evaluation runs on the scored frame: score ``approval_probability`` against
the recorded decision ``historical_approved``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fround, fround_sql, hash_uniforms, hash_uniforms_sql
from ..operators import enrich
from ..operators import evaluate as ev
from ..operators import split as sp
from .analysis_frame import analysis_frame, analysis_frame_sql
from .fixtures import SQL_APPLICATIONS_V1, V1_CATEGORICAL, V1_NUMERIC_RAW, applications_v1

SPLIT_SEED, FOLD_SEED, FOLDS, REPEATS, TEST_SIZE = 2026, 42, 5, 3, 0.2
FAIRNESS_ATTRIBUTES = ["gender", "education", "property_area"]
GAP_ATTRIBUTE, GAP_GROUPS = "gender", ("Female", "Male")
NOISE_SCALE = 2.0


def _labelled(spark, sf_dir) -> DataFrame:
    a = applications_v1(spark, sf_dir)
    return a.select("application_id", (F.trim(F.col("loan_status")) == "Y").cast("int").alias("label"))


def _scored(spark, sf_dir) -> DataFrame:
    f = analysis_frame(spark, sf_dir)
    return f.select("application_id", "gender", "education", "property_area",
                    F.col("historical_approved").cast("int").alias("y"),
                    F.col("approval_probability").alias("p"))


_LABEL_SQL = "CAST(trim(loan_status) = 'Y' AS INTEGER)"
_SCORED_SQL = """,
scored AS (SELECT application_id, gender, education, property_area,
                  CAST(historical_approved AS INTEGER) AS y, approval_probability AS p FROM analysis)"""


# ------------------------------------------------------------------ Spark

def enrich_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = applications_v1(spark, sf_dir)
    us = hash_uniforms(F.col("application_id"), "ops1")
    return a.select("application_id", *[u.alias(f"u{i + 1}") for i, u in enumerate(us)])


def enrich_weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_frame(spark, sf_dir).select("application_id", "recent", "channel")


def enrich_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_frame(spark, sf_dir).select("application_id", "day_offset", "simulation_day",
                                                "created_at", "recent")


def enrich_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = applications_v1(spark, sf_dir)
    us = hash_uniforms(F.col("application_id"), "ops2")
    return a.select("application_id", fround(enrich.gamma2(us[2], us[3], NOISE_SCALE), 9).alias("queue_noise"))


def enrich_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis_frame(spark, sf_dir).select("application_id", "baseline_route", "analyst")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.stratified_split(_labelled(spark, sf_dir), "application_id", "label", TEST_SIZE, SPLIT_SEED)


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.stratified_folds(_labelled(spark, sf_dir), "application_id", "label", FOLDS, FOLD_SEED)


def repeated_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.repeated_folds(_labelled(spark, sf_dir), "application_id", "label", FOLDS, REPEATS, FOLD_SEED)


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = ev.class_balance(_labelled(spark, sf_dir), "label")
    return b.select("approved", "rejected", F.round("approval_rate", 6).alias("approval_rate"))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ev.class_weights(_labelled(spark, sf_dir), "label")
    return w.select("label", "count", fround("weight", 9).alias("weight"))


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_long(_scored(spark, sf_dir), "y", "p", 0.5)


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ev.classification_metrics(_scored(spark, sf_dir), "y", "p", 0.5)
    return m.select("tn", "fp", "fn", "tp", *[fround(c, 6).alias(c) for c in
                                              ("accuracy", "balanced_accuracy", "precision", "recall",
                                               "recall_0", "f1")])


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.auc(_scored(spark, sf_dir), "y", "p").select(fround("auc", 9).alias("auc"))


def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.brier(_scored(spark, sf_dir), "y", "p").select(F.round("brier", 6).alias("brier"))


def _slices(spark, sf_dir):
    return ev.fairness_slices(_scored(spark, sf_dir), "y", "p", FAIRNESS_ATTRIBUTES, 0.5, 10)


def fairness_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _slices(spark, sf_dir)
    return s.select("attribute", "group", "n", *[F.round(c, 6).alias(c) for c in
                                                ("actual_rate", "predicted_rate", "mean_score")],
                    *[fround(c, 6).alias(c) for c in ("balanced_accuracy", "recall", "recall_0")])


def fairness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = ev.fairness_gaps(_slices(spark, sf_dir), GAP_ATTRIBUTE, GAP_GROUPS)
    return g.select(*[F.round(c, 6).alias(c) for c in g.columns])


def feature_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = applications_v1(spark, sf_dir).withColumn(
        "credit_history", F.col("credit_history").cast("int").cast("string"))
    return ev.feature_baselines(a, V1_CATEGORICAL, V1_NUMERIC_RAW)


# ------------------------------------------------------------------ DuckDB

def sql_enrich_uniform() -> str:
    us = hash_uniforms_sql("application_id", "ops1")
    return "WITH " + SQL_APPLICATIONS_V1 + "\nSELECT application_id, " + \
        ", ".join(f"{u} AS u{i + 1}" for i, u in enumerate(us)) + " FROM applications_v1"


def sql_enrich_weighted_choice() -> str:
    return "WITH " + analysis_frame_sql() + "\nSELECT application_id, recent, channel FROM analysis"


def sql_enrich_timestamps() -> str:
    return "WITH " + analysis_frame_sql() + \
        "\nSELECT application_id, day_offset, simulation_day, created_at, recent FROM analysis"


def sql_enrich_noise() -> str:
    us = hash_uniforms_sql("application_id", "ops2")
    return "WITH " + SQL_APPLICATIONS_V1 + \
        f"\nSELECT application_id, {fround_sql(enrich.gamma2_sql(us[2], us[3], NOISE_SCALE), 9)} AS queue_noise " \
        "FROM applications_v1"


def sql_enrich_assignment() -> str:
    return "WITH " + analysis_frame_sql() + "\nSELECT application_id, baseline_route, analyst FROM analysis"


def _ranked_sql(seed) -> str:
    return f""",
lab AS (SELECT application_id, {_LABEL_SQL} AS label FROM applications_v1),
rk AS (SELECT application_id, label,
         row_number() OVER (PARTITION BY label ORDER BY {sp.order_key_sql('application_id', seed)}, application_id) - 1
           AS rn, count(*) OVER (PARTITION BY label) AS n
       FROM lab)"""


def sql_stratified_split() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _ranked_sql(SPLIT_SEED) + f"""
SELECT application_id, label, CASE WHEN rn < floor(n * {TEST_SIZE} + 0.5) THEN 'test' ELSE 'dev' END AS split
FROM rk"""


def sql_stratified_folds() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _ranked_sql(FOLD_SEED) + \
        f"\nSELECT application_id, label, CAST(rn % {FOLDS} AS INTEGER) AS fold FROM rk"


def sql_repeated_folds() -> str:
    key = (f"('0x' || substr(md5(CAST(application_id AS VARCHAR) || ':{FOLD_SEED}-' || CAST(repeat AS VARCHAR)),"
           f" 1, 15))::BIGINT")
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
lab AS (SELECT application_id, {_LABEL_SQL} AS label FROM applications_v1),
x AS (SELECT l.*, CAST(r.range AS INTEGER) AS repeat FROM lab l CROSS JOIN range({REPEATS}) r)
SELECT application_id, label, repeat,
  CAST((row_number() OVER (PARTITION BY repeat, label ORDER BY {key}, application_id) - 1) % {FOLDS} AS INTEGER) AS fold
FROM x"""


def sql_class_balance() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + f"""
SELECT count_if({_LABEL_SQL} = 1) AS approved, count_if({_LABEL_SQL} = 0) AS rejected,
       round(avg(CAST({_LABEL_SQL} AS DOUBLE)), 6) AS approval_rate
FROM applications_v1"""


def sql_class_weights() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
c AS (SELECT {_LABEL_SQL} AS label, count(*) AS count FROM applications_v1 GROUP BY 1)
SELECT label, count, {fround_sql('(SELECT sum(count) FROM c) / ((SELECT count(*) FROM c) * count)', 9)} AS weight
FROM c"""


def _counts_sql() -> str:
    return """count_if(y = 0 AND p < 0.5) AS tn, count_if(y = 0 AND p >= 0.5) AS fp,
  count_if(y = 1 AND p < 0.5) AS fn, count_if(y = 1 AND p >= 0.5) AS tp"""


def sql_confusion() -> str:
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + f""",
c AS (SELECT {_counts_sql()} FROM scored)
SELECT 0 AS actual, 0 AS predicted, tn AS count FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c"""


def _div(a, b):
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


def sql_classification_metrics() -> str:
    rec1, rec0, prec = _div("tp", "tp + fn"), _div("tn", "tn + fp"), _div("tp", "tp + fp")
    f1 = _div(f"2 * {prec} * {rec1}", f"{prec} + {rec1}")
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + f""",
c AS (SELECT {_counts_sql()} FROM scored)
SELECT tn, fp, fn, tp, {fround_sql(_div('tp + tn', 'tn + fp + fn + tp'), 6)} AS accuracy,
  {fround_sql(f'({rec1} + {rec0}) / 2.0', 6)} AS balanced_accuracy, {fround_sql(prec, 6)} AS precision,
  {fround_sql(rec1, 6)} AS recall, {fround_sql(rec0, 6)} AS recall_0, {fround_sql(f1, 6)} AS f1
FROM c"""


def sql_roc_auc() -> str:
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + f""",
r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS ar FROM scored
      WHERE p IS NOT NULL AND y IS NOT NULL),
s AS (SELECT sum(CASE WHEN y = 1 THEN ar ELSE 0 END) AS rs, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM r)
SELECT {fround_sql('CASE WHEN pos > 0 AND neg > 0 THEN (rs - pos * (pos + 1) / 2.0) / (pos * neg) END', 9)} AS auc
FROM s"""


def sql_brier() -> str:
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + "\nSELECT round(avg(pow(p - y, 2)), 6) AS brier FROM scored"


def _slices_sql() -> str:
    parts = [f"""SELECT '{a}' AS attribute, coalesce(CAST({a} AS VARCHAR), 'Missing') AS "group", count(*) AS n,
      avg(CAST(y AS DOUBLE)) AS actual_rate, avg(CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END) AS predicted_rate,
      avg(p) AS mean_score, {_counts_sql()}
    FROM scored GROUP BY 1, 2""" for a in FAIRNESS_ATTRIBUTES]
    rec1, rec0 = _div("tp", "tp + fn"), _div("tn", "tn + fp")
    npres = "((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END))"
    bal = _div(f"(CASE WHEN tp + fn > 0 THEN {rec1} ELSE 0.0 END) + (CASE WHEN tn + fp > 0 THEN {rec0} ELSE 0.0 END)",
               f"CAST({npres} AS DOUBLE)")
    return f""",
g AS ({" UNION ALL ".join(parts)}),
slices AS (SELECT attribute, "group", n, actual_rate, predicted_rate, mean_score,
                  {bal} AS balanced_accuracy, {rec1} AS recall, {rec0} AS recall_0
           FROM g WHERE n >= 10)"""


def sql_fairness_slices() -> str:
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + _slices_sql() + """
SELECT attribute, "group", n, round(actual_rate, 6) AS actual_rate, round(predicted_rate, 6) AS predicted_rate,
  round(mean_score, 6) AS mean_score, """ + ", ".join(
        f"{fround_sql(c, 6)} AS {c}" for c in ("balanced_accuracy", "recall", "recall_0")) + " FROM slices"


def sql_fairness_gaps() -> str:
    groups = ", ".join(f"'{g}'" for g in GAP_GROUPS)
    return "WITH " + analysis_frame_sql() + _SCORED_SQL + _slices_sql() + f"""
SELECT round(max(predicted_rate) - min(predicted_rate), 6) AS demographic_parity_gap,
  round(max(recall) - min(recall), 6) AS equal_opportunity_gap,
  round(max(recall_0) - min(recall_0), 6) AS rejection_recall_gap
FROM slices WHERE attribute = '{GAP_ATTRIBUTE}' AND "group" IN ({groups})
HAVING count(*) = {len(GAP_GROUPS)}"""


def sql_feature_baselines() -> str:
    def cat(c):
        v = f"CAST(CAST({c} AS INTEGER) AS VARCHAR)" if c == "credit_history" else f"CAST({c} AS VARCHAR)"
        return f"""SELECT '{c}' AS feature, 'categorical' AS kind, coalesce((SELECT v FROM (
            SELECT {v} AS v, count(*) AS c FROM applications_v1 WHERE {c} IS NOT NULL GROUP BY 1)
            ORDER BY c DESC, v ASC LIMIT 1), 'Unknown') AS category, CAST(NULL AS DOUBLE) AS number"""
    nums = [f"SELECT '{c}', 'numeric', CAST(NULL AS VARCHAR), coalesce(quantile_cont({c}, 0.5), 0.0) "
            f"FROM applications_v1" for c in V1_NUMERIC_RAW]
    return "WITH " + SQL_APPLICATIONS_V1 + "\n" + " UNION ALL ".join([cat(c) for c in V1_CATEGORICAL] + nums)


QUERIES = {
    "enrich_uniform": (enrich_uniform, sql_enrich_uniform),
    "enrich_weighted_choice": (enrich_weighted_choice, sql_enrich_weighted_choice),
    "enrich_timestamps": (enrich_timestamps, sql_enrich_timestamps),
    "enrich_noise": (enrich_noise, sql_enrich_noise),
    "enrich_assignment": (enrich_assignment, sql_enrich_assignment),
    "stratified_split": (stratified_split, sql_stratified_split),
    "stratified_folds": (stratified_folds, sql_stratified_folds),
    "repeated_folds": (repeated_folds, sql_repeated_folds),
    "class_balance": (class_balance, sql_class_balance),
    "class_weights": (class_weights, sql_class_weights),
    "confusion": (confusion, sql_confusion),
    "classification_metrics": (classification_metrics, sql_classification_metrics),
    "roc_auc": (roc_auc, sql_roc_auc),
    "brier": (brier, sql_brier),
    "fairness_slices": (fairness_slices, sql_fairness_slices),
    "fairness_gaps": (fairness_gaps, sql_fairness_gaps),
    "feature_baselines": (feature_baselines, sql_feature_baselines),
}
