"""Data contract, cleaning, profiling and feature queries (Spark + DuckDB)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clip_sql, fround, fround_sql
from ..operators import clean as cl
from ..operators import features as fe
from ..operators import profile as pr
from ..operators import validate as va
from ..sources.tables import read_table
from dataclasses import replace

from .fixtures import (ASSET_COLUMNS, SQL_APPLICATIONS_BOTH, SQL_APPLICATIONS_V1, SQL_APPLICATIONS_V2_RAW,
                       V1_COLUMNS,
                       V1_PREDICTORS, V2_PREDICTORS, applications_v1, applications_v2_raw)

V1_EXPECT = va.Expectation("v1", tuple(V1_COLUMNS), min_rows=500, label_col="loan_status",
                           allowed_labels=("Y", "N"), forbidden=("gender",))
V2_EXPECT = va.Expectation("v2", tuple(["loan_id", *V2_PREDICTORS, "loan_status"]), min_rows=4000, min_usable=4000,
                           label_col="loan_status", allowed_labels=tuple(cl.TARGET_MAP),
                           forbidden=("gender",))
APPROVAL_BY_COLUMNS = ["credit_history", "property_area", "education", "married", "dependents",
                       "self_employed"]
DESCRIBE_COLUMNS = ["applicant_income", "coapplicant_income", "loan_amount", "loan_amount_term",
                    "credit_history"]
V1_FEATURES = ["total_income", "log_total_income", "log_loan_amount", "loan_to_annual_income",
               "monthly_principal_proxy"]
V2_FEATURES = ["total_assets", "loan_to_income", "asset_to_loan", "bank_assets_to_income",
               "loan_per_term_year", "net_worth_proxy", "cibil_x_asset_coverage"]
FINGERPRINT_TABLE = "orders"


def _r6(cols):
    return [fround(c, 6).alias(c) for c in cols]


# ------------------------------------------------------------------ Spark

def features_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.add_v1_features(applications_v1(spark, sf_dir)).select("application_id", *_r6(V1_FEATURES))


def features_v1_eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fe.add_v1_features(applications_v1(spark, sf_dir), fill_income_nulls=False)
    return f.select("application_id", *_r6(V1_FEATURES))


def clean_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_v2(applications_v2_raw(spark, sf_dir))


def clean_v2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_v2_report(applications_v2_raw(spark, sf_dir))


def features_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fe.add_v2_features(cl.clean_v2(applications_v2_raw(spark, sf_dir)))
    return f.select("loan_id", *_r6(V2_FEATURES), "cibil_band")


def validate_rows_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validate_rows(applications_v1(spark, sf_dir).select("application_id", *V1_PREDICTORS),
                            va.V1_RULES, "application_id")


PARTIAL_COLUMNS = ["applicant_income", "loan_amount", "credit_history", "married"]


def validate_rows_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive without most optional columns: absent columns take their defaults,
    nulls of columns that are there stay violations."""
    return va.validate_rows(applications_v1(spark, sf_dir).select("application_id", *PARTIAL_COLUMNS),
                            va.V1_RULES, "application_id")


def validate_rows_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validate_rows(cl.normalize(applications_v2_raw(spark, sf_dir)), va.V2_RULES, "loan_id")


def dataset_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    v1 = applications_v1(spark, sf_dir)
    v2 = cl.normalize(applications_v2_raw(spark, sf_dir))
    scoring_input = v1.select("application_id", *V1_PREDICTORS)
    # the scoring contract is closed: with the whole table as input, gender and the label are refused
    contract = va.Expectation("v1_scoring", ("application_id", *V1_PREDICTORS), forbidden=("gender",), optional=())
    forb = va.dataset_checks(scoring_input, contract)
    extra = va.dataset_checks(v1, replace(contract, name="v1_table_as_scoring_input"))
    return (va.dataset_checks(v1, replace(V1_EXPECT, forbidden=()))
            .unionByName(va.dataset_checks(v2, V2_EXPECT))
            .unionByName(forb.where(F.col("check").endswith("_columns")))
            .unionByName(extra.where(F.col("check").endswith("_columns"))))


def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    v1 = applications_v1(spark, sf_dir)
    return pr.quality_profile(v1, "application_id", F.trim(F.col("loan_status")) == "Y")


def missing_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.missing_by_field(applications_v1(spark, sf_dir))


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.value_counts(applications_v1(spark, sf_dir), "loan_status", {"Y": "Approved", "N": "Rejected"})


def approval_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.approval_by(applications_v1(spark, sf_dir), APPROVAL_BY_COLUMNS,
                          F.trim(F.col("loan_status")) == "Y")


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.describe_numeric(applications_v1(spark, sf_dir), DESCRIBE_COLUMNS)


def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, FINGERPRINT_TABLE).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.floor(F.col("o_totalprice") * 100 + 0.5).cast("long").alias("cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return pr.row_fingerprint(o, o.columns).select(F.lit(FINGERPRINT_TABLE).alias("table"), "*")


# ------------------------------------------------------------------ DuckDB

def _sql_clean_ctes() -> str:
    num = {"no_of_dependents", "income_annum", "loan_amount", "loan_term", "cibil_score", *ASSET_COLUMNS}
    sel = ["loan_id"]
    for c in V2_PREDICTORS:
        src = f'" {c}"'
        sel.append(f"TRY_CAST({src} AS DOUBLE) AS {c}" if c in num else f"trim({src}) AS {c}")
    sel.append('trim(" loan_status") AS loan_status')
    clipped = ", ".join(f"CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END AS {c}" if c in ASSET_COLUMNS else c
                        for c in ["loan_id", *V2_PREDICTORS, "loan_status", "target"])
    subset = ", ".join([*V2_PREDICTORS, "loan_status"])
    return f""",
norm AS (
  SELECT *, CASE loan_status WHEN 'Approved' THEN 1 WHEN 'Rejected' THEN 0 END AS target
  FROM (SELECT {", ".join(sel)} FROM applications_v2_raw)
),
clipped AS (SELECT {clipped} FROM norm),
clean AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY {subset} ORDER BY loan_id) AS rn_ FROM clipped)
  WHERE rn_ = 1
)"""


def sql_features_v1(fill=True) -> str:
    total = ("coalesce(applicant_income, 0.0) + coalesce(coapplicant_income, 0.0)" if fill
             else "applicant_income + coapplicant_income")
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
t AS (SELECT application_id, loan_amount, loan_amount_term, {total} AS total_income FROM applications_v1)
SELECT application_id, {fround_sql('total_income', 6)} AS total_income,
  {fround_sql(f"ln(1.0 + {clip_sql('total_income', 0.0)})", 6)} AS log_total_income,
  {fround_sql(f"ln(1.0 + {clip_sql('loan_amount', 0.0)})", 6)} AS log_loan_amount,
  {fround_sql('loan_amount * 1000.0 / nullif(total_income * 12.0, 0.0)', 6)} AS loan_to_annual_income,
  {fround_sql('loan_amount * 1000.0 / nullif(loan_amount_term, 0.0)', 6)} AS monthly_principal_proxy
FROM t"""


def sql_features_v1_eda() -> str:
    return sql_features_v1(False)


def sql_clean_v2() -> str:
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + "\nSELECT * FROM clean"


def sql_clean_v2_report() -> str:
    cols = ["loan_id", *V2_PREDICTORS, "loan_status", "target"]
    neg = ", ".join(f"count_if({c} < 0) AS neg_{c}" for c in ASSET_COLUMNS)
    miss = ", ".join(f"count_if({c} IS NULL) AS miss_{c}" for c in cols)
    rows = ["SELECT 'rows_before_deduplication' AS metric, '' AS field, CAST(rows_before AS BIGINT) AS value FROM b",
            "SELECT 'rows', '', CAST(rows_after AS BIGINT) FROM a",
            "SELECT 'duplicate_feature_rows_removed', '', CAST(rows_before - rows_after AS BIGINT) FROM b, a"]
    rows += [f"SELECT 'negative_asset_values_clipped', '{c}', CAST(neg_{c} AS BIGINT) FROM b" for c in ASSET_COLUMNS]
    rows += [f"SELECT 'missing_values', '{c}', CAST(miss_{c} AS BIGINT) FROM a WHERE miss_{c} > 0" for c in cols]
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f""",
b AS (SELECT count(*) AS rows_before, {neg} FROM norm),
a AS (SELECT count(*) AS rows_after, {miss} FROM clean)
""" + "\nUNION ALL ".join(rows)


def sql_features_v2() -> str:
    inc = clip_sql("income_annum", 0.0)
    loan = clip_sql("loan_amount", 0.0)
    term = clip_sql("loan_term", 1.0)
    tot = " + ".join(f"coalesce({c}, 0.0)" for c in ASSET_COLUMNS)
    band = ("CASE WHEN cibil_score IS NULL THEN NULL WHEN cibil_score <= 499 THEN 'weak' "
            "WHEN cibil_score <= 649 THEN 'fair' WHEN cibil_score <= 749 THEN 'good' ELSE 'excellent' END")
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + f""",
f AS (SELECT loan_id, cibil_score, bank_asset_value, {inc} AS inc_, {loan} AS loan_, {term} AS term_,
             {tot} AS total_assets FROM clean),
g AS (SELECT *, total_assets / (loan_ + 1.0) AS asset_to_loan FROM f)
SELECT loan_id, {fround_sql('total_assets', 6)} AS total_assets, {fround_sql('loan_ / (inc_ + 1.0)', 6)} AS loan_to_income,
  {fround_sql('asset_to_loan', 6)} AS asset_to_loan, {fround_sql('bank_asset_value / (inc_ + 1.0)', 6)} AS bank_assets_to_income,
  {fround_sql('loan_ / term_', 6)} AS loan_per_term_year, {fround_sql('total_assets - loan_', 6)} AS net_worth_proxy,
  {fround_sql(f"cibil_score * ln(1.0 + {clip_sql('asset_to_loan', 0.0)})", 6)} AS cibil_x_asset_coverage,
  {band} AS cibil_band
FROM g"""


def _rule_sql(name, spec) -> str:
    kind, arg = spec[0], spec[1]
    if kind == "enum":
        vals = ", ".join(f"'{v}'" for v in arg)
        return f"coalesce(trim(CAST({name} AS VARCHAR)) IN ({vals}), false)"
    if kind == "enum_num":
        vals = ", ".join(repr(float(v)) for v in arg)
        return f"coalesce(TRY_CAST({name} AS DOUBLE) IN ({vals}), false)"
    x = f"TRY_CAST({name} AS DOUBLE)"
    if kind == "int_range":
        lo, hi = arg
        return f"coalesce({x} >= {lo} AND {x} <= {hi} AND {x} = floor({x}), false)"
    lo, incl, hi = arg
    op = ">=" if incl else ">"
    return f"coalesce({x} {op} {lo!r} AND {x} <= {hi!r} AND isfinite({x}), false)"


def _validate_sql(rules, id_col, source) -> str:
    fails = [f"CASE WHEN NOT {_rule_sql(n, s)} THEN '{n}' END" for n, s in rules.items()]
    cnt = " + ".join(f"CAST(NOT {_rule_sql(n, s)} AS INTEGER)" for n, s in rules.items())
    return f"""
SELECT {id_col}, CAST({cnt} AS BIGINT) AS violation_count,
  concat_ws(',', {", ".join(fails)}) AS violations,
  ({cnt}) = 0 AS valid
FROM {source}"""


def sql_validate_rows_v1() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + _validate_sql(va.V1_RULES, "application_id", "applications_v1")


def sql_validate_rows_partial() -> str:
    def default(name, spec):
        return f"{spec[2]!r} AS {name}"
    absent = ", ".join(default(n, s) for n, s in va.V1_RULES.items() if n not in PARTIAL_COLUMNS)
    return "WITH " + SQL_APPLICATIONS_V1 + f""",
partial AS (SELECT application_id, {", ".join(PARTIAL_COLUMNS)}, {absent} FROM applications_v1)""" + _validate_sql(
        va.V1_RULES, "application_id", "partial")


def sql_validate_rows_v2() -> str:
    return "WITH " + SQL_APPLICATIONS_V2_RAW + _sql_clean_ctes() + _validate_sql(va.V2_RULES, "loan_id", "norm")


def _label_checks(name, src, allowed, min_rows, min_usable=0) -> str:
    al = ", ".join(f"'{a}'" for a in allowed)
    return f"""
SELECT '{name}.required_columns' AS "check", true AS passed, '' AS detail
UNION ALL SELECT '{name}.forbidden_columns', true, ''
UNION ALL SELECT '{name}.row_count', count(*) >= {min_rows}, CAST(count(*) AS VARCHAR) FROM {src}
UNION ALL SELECT '{name}.usable_rows', count_if(coalesce(trim(loan_status) IN ({al}), false)) >= {min_usable},
  CAST(count_if(coalesce(trim(loan_status) IN ({al}), false)) AS VARCHAR) FROM {src}
UNION ALL SELECT '{name}.label_domain', count_if(trim(loan_status) IS NOT NULL AND trim(loan_status) NOT IN ({al})) = 0,
  CAST(count_if(trim(loan_status) IS NOT NULL AND trim(loan_status) NOT IN ({al})) AS VARCHAR) FROM {src}
UNION ALL SELECT '{name}.unexpected_label', false, trim(loan_status) || ': ' || CAST(count(*) AS VARCHAR) FROM {src}
  WHERE trim(loan_status) IS NOT NULL AND trim(loan_status) NOT IN ({al}) GROUP BY trim(loan_status)
UNION ALL SELECT '{name}.unmapped_labels', count_if(NOT coalesce(trim(loan_status) IN ({al}), false)) = 0,
  CAST(count_if(NOT coalesce(trim(loan_status) IN ({al}), false)) AS VARCHAR) FROM {src}"""


def sql_v2_checks() -> str:
    return _label_checks("v2", "norm", tuple(cl.TARGET_MAP), V2_EXPECT.min_rows, V2_EXPECT.min_usable)


def sql_dataset_checks() -> str:
    return ("WITH " + SQL_APPLICATIONS_BOTH + _sql_clean_ctes()
            + _label_checks("v1", "applications_v1", ("Y", "N"), V1_EXPECT.min_rows, V1_EXPECT.min_usable)
            + "\nUNION ALL" + sql_v2_checks()
            + "".join(f"\nUNION ALL SELECT '{t}.{c}', {ok}, '{d}'" for t, c, ok, d in (
                ("v1_scoring", "required_columns", "true", ""), ("v1_scoring", "forbidden_columns", "true", ""),
                ("v1_scoring", "unknown_columns", "true", ""),
                ("v1_table_as_scoring_input", "required_columns", "true", ""),
                ("v1_table_as_scoring_input", "forbidden_columns", "false", "gender"),
                ("v1_table_as_scoring_input", "unknown_columns", "false", "gender,loan_status"))))


def sql_quality_profile() -> str:
    cols = ", ".join(V1_COLUMNS)
    miss = " + ".join(f"count_if({c} IS NULL)" for c in V1_COLUMNS)
    return "WITH " + SQL_APPLICATIONS_V1 + f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(V1_COLUMNS)} AS BIGINT) AS columns,
  CAST((SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM applications_v1 GROUP BY {cols})) AS BIGINT)
    AS duplicate_rows,
  CAST((SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM applications_v1 GROUP BY application_id)) AS BIGINT)
    AS duplicate_ids,
  CAST({miss} AS BIGINT) AS missing_cells,
  round(avg(CASE WHEN trim(loan_status) = 'Y' THEN 1.0 ELSE 0.0 END), 6) AS historical_approval_rate
FROM applications_v1"""


def sql_missing_by_field() -> str:
    parts = [f"SELECT '{c}' AS field, CAST(count_if({c} IS NULL) AS BIGINT) AS missing, "
             f"round(count_if({c} IS NULL) / count(*), 6) AS rate FROM applications_v1" for c in V1_COLUMNS]
    return "WITH " + SQL_APPLICATIONS_V1 + "\nSELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing > 0"


def sql_value_counts() -> str:
    return "WITH " + SQL_APPLICATIONS_V1 + """
SELECT coalesce(CASE loan_status WHEN 'Y' THEN 'Approved' WHEN 'N' THEN 'Rejected' END, 'Missing') AS value,
       count(*) AS count
FROM applications_v1 GROUP BY 1"""


def sql_approval_by() -> str:
    parts = [f"SELECT '{c}' AS column, coalesce(CAST({c} AS VARCHAR), 'Missing') AS value, count(*) AS applications, "
             f"round(avg(CASE WHEN trim(loan_status) = 'Y' THEN 1.0 ELSE 0.0 END) * 100, 1) AS approval_pct "
             f"FROM applications_v1 GROUP BY 1, 2" for c in APPROVAL_BY_COLUMNS]
    return "WITH " + SQL_APPLICATIONS_V1 + "\n" + " UNION ALL ".join(parts)


def sql_describe_numeric() -> str:
    parts = [f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean,
      round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
      round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
      round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max
    FROM applications_v1""" for c in DESCRIBE_COLUMNS]
    return "WITH " + SQL_APPLICATIONS_V1 + "\n" + " UNION ALL ".join(parts)


def sql_row_fingerprint() -> str:
    text = pr.canonical_sql(["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus",
                             "o_orderpriority", "CAST(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS VARCHAR)",
                             "strftime(o_orderdate, '%Y-%m-%d')"])
    return f"""SELECT '{FINGERPRINT_TABLE}' AS "table", count(*) AS rows,
  CAST(sum(('0x' || substr(md5({text}), 1, 15))::HUGEINT) AS VARCHAR) AS hash_sum
FROM {FINGERPRINT_TABLE}"""


QUERIES = {
    "features_v1": (features_v1, sql_features_v1),
    "features_v1_eda": (features_v1_eda, sql_features_v1_eda),
    "features_v2": (features_v2, sql_features_v2),
    "clean_v2": (clean_v2, sql_clean_v2),
    "clean_v2_report": (clean_v2_report, sql_clean_v2_report),
    "validate_rows_v1": (validate_rows_v1, sql_validate_rows_v1),
    "validate_rows_v2": (validate_rows_v2, sql_validate_rows_v2),
    "validate_rows_partial": (validate_rows_partial, sql_validate_rows_partial),
    "dataset_checks": (dataset_checks, sql_dataset_checks),
    "quality_profile": (quality_profile, sql_quality_profile),
    "missing_by_field": (missing_by_field, sql_missing_by_field),
    "value_counts": (value_counts, sql_value_counts),
    "approval_by": (approval_by, sql_approval_by),
    "describe_numeric": (describe_numeric, sql_describe_numeric),
    "row_fingerprint": (row_fingerprint, sql_row_fingerprint),
}
