"""Application tables derived from the given star schema.

The decision operators run on any scored application table.  The test
tables carry orders, customers and line items, so the fixtures map them to
the two application layouts (v1: ten predictors plus label; v2: eleven
predictors plus label, raw column names with leading blanks).  Every value
is a deterministic function of the source rows (plus stable hash draws for
fields the source lacks), so the work grows with the input.

Plan shape: ``lineitem`` is pre-aggregated per order (partial aggregation
before the shuffle on ``l_orderkey``), joined to ``orders`` on the same key
(co-partitioned), then to ``customer`` on ``custkey`` (shuffle join at scale;
AQE picks broadcast only when the runtime size is small) and to the two
fixed-size dimension tables ``nation`` (25 rows) and ``region`` (5 rows),
which are broadcast.

FIXTURES.md documents the mapping; ``SQL_*`` strings below are the same
derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_uniforms, hash_uniforms_sql
from ..session import materialize
from ..sources.tables import read_table

# Fixed values of the fixture mapping (ours, documented in FIXTURES.md).
GRADUATE_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")
AREA_BY_REGION = {"AMERICA": "Urban", "EUROPE": "Urban", "ASIA": "Semiurban",
                  "MIDDLE EAST": "Semiurban", "AFRICA": "Rural"}

V1_COLUMNS = [
    "application_id", "gender", "married", "dependents", "education", "self_employed",
    "applicant_income", "coapplicant_income", "loan_amount", "loan_amount_term",
    "credit_history", "property_area", "loan_status",
]
V1_PREDICTORS = [
    "married", "dependents", "education", "self_employed", "applicant_income",
    "coapplicant_income", "loan_amount", "loan_amount_term", "credit_history",
    "property_area",
]
V1_CATEGORICAL = ["married", "dependents", "education", "self_employed",
                  "credit_history", "property_area"]
V1_NUMERIC_RAW = ["applicant_income", "coapplicant_income", "loan_amount", "loan_amount_term"]

V2_RAW_COLUMNS = [
    "loan_id", " no_of_dependents", " education", " self_employed", " income_annum",
    " loan_amount", " loan_term", " cibil_score", " residential_assets_value",
    " commercial_assets_value", " luxury_assets_value", " bank_asset_value", " loan_status",
]
V2_PREDICTORS = [
    "no_of_dependents", "education", "self_employed", "income_annum", "loan_amount",
    "loan_term", "cibil_score", "residential_assets_value", "commercial_assets_value",
    "luxury_assets_value", "bank_asset_value",
]
ASSET_COLUMNS = ["residential_assets_value", "commercial_assets_value",
                 "luxury_assets_value", "bank_asset_value"]


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined orders, written once: both application layouts are projections of them."""
    return materialize(lambda: build_order_base(spark, sf_dir), "order_base", (sf_dir,), spark)


def build_order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⟕ per-order line aggregate ⟕ customer ⟕ nation ⟕ region."""
    li = (read_table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n_lines"),
               # whole units per line: an exact, order-independent sum
               F.sum(F.floor(F.col("l_extendedprice") * F.col("l_discount"))).cast("double")
               .alias("disc_value"),
               F.count_if(F.col("l_returnflag") == "R").alias("n_returned")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    return (orders
            .join(li, orders.o_orderkey == li.l_orderkey, "left")
            .join(cust, orders.o_custkey == cust.c_custkey, "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("o_orderkey", "c_custkey", "o_totalprice", "o_orderpriority", "o_orderdate", "n_lines", "disc_value",
                    "n_returned", "c_acctbal", "c_mktsegment", "r_name"))


def with_draws(base: DataFrame, *groups: str) -> DataFrame:
    """The draws of ``groups``: functions of the keys, so each layout makes those it
    reads and none is shuffled or stored."""
    made = []
    for g in groups:
        key, salt = _SALTS[g]
        made += [u.alias(n) for n, u in zip(_DRAWS[g], hash_uniforms(F.col(key), salt, len(_DRAWS[g])))]
    return base.select("*", *made)


# Per-row draws for fields the source lacks: one md5 digest gives four.
_DRAWS = {
    "o1": ["u_credit", "u_label", "u_self", "u_loan"],
    "o2": ["u_term", "u_self2", "u_status"],
    "c1": ["u_gender", "u_married", "u_dependents", "u_cibil"],
    "c2": ["u_dependents2", "u_commercial", "u_bank"],
}
_SALTS = {"o1": ("o_orderkey", "app1"), "o2": ("o_orderkey", "app2"),
          "c1": ("c_custkey", "cust1"), "c2": ("c_custkey", "cust2")}


def applications_v1_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The v1 application table with the day of each application,
    materialised once per session (it is the input table every v1 report reads)."""
    return materialize(lambda: build_applications_v1(spark, sf_dir), "applications_v1", (sf_dir,), spark)


def applications_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the v1 layout alone."""
    return applications_v1_dated(spark, sf_dir).select(*V1_COLUMNS)


def applications_v2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(lambda: build_applications_v2_raw(spark, sf_dir), "applications_v2_raw", (sf_dir,), spark)


def build_applications_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = with_draws(order_base(spark, sf_dir), "o1", "o2", "c1")
    o = F.col("o_orderkey")
    U = F.col
    area = F.lit(None).cast("string")
    for reg, val in AREA_BY_REGION.items():
        area = F.when(F.col("r_name") == reg, F.lit(val)).otherwise(area)
    credit = (F.when(F.col("n_lines").isNull() | (U("u_credit") < 0.08), F.lit(None).cast("double"))
              .when(F.col("n_returned") * 3 <= F.col("n_lines"), F.lit(1.0))
              .otherwise(F.lit(0.0)))
    ul = U("u_label")
    out = b.select(
        o.alias("application_id"),
        F.when(U("u_gender") < 0.18, "Female").when(U("u_gender") < 0.98, "Male").alias("gender"),
        F.when(U("u_married") < 0.35, "No").when(U("u_married") < 0.995, "Yes").alias("married"),
        F.when(U("u_dependents") < 0.57, "0").when(U("u_dependents") < 0.74, "1")
         .when(U("u_dependents") < 0.90, "2").when(U("u_dependents") < 0.975, "3+")
         .alias("dependents"),
        F.when(F.col("c_mktsegment").isin(*GRADUATE_SEGMENTS), "Graduate")
         .otherwise("Not Graduate").alias("education"),
        F.when(U("u_self") < 0.05, F.lit(None).cast("string"))
         .when(F.col("o_orderpriority") == "1-URGENT", "Yes").otherwise("No").alias("self_employed"),
        F.col("c_acctbal").alias("applicant_income"),
        F.col("disc_value").alias("coapplicant_income"),
        F.when(U("u_loan") < 0.035, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 1000.0).alias("loan_amount"),
        F.when(U("u_term") < 0.02, F.lit(None).cast("double"))
         .otherwise((F.col("n_lines") * 60).cast("double")).alias("loan_amount_term"),
        credit.alias("credit_history"),
        area.alias("property_area"),
        F.when(credit == 1.0, F.when(ul < 0.92, "Y").otherwise("N"))
         .when(credit == 0.0, F.when(ul < 0.06, "Y").otherwise("N"))
         .otherwise(F.when(ul < 0.6, "Y").otherwise("N")).alias("loan_status"),
        F.to_date("o_orderdate").alias("applied_on"),
    )
    return out


def build_applications_v2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The v2 layout as it arrives: blank-prefixed names and values."""
    b = with_draws(order_base(spark, sf_dir), "o2", "c1", "c2")
    o = F.col("o_orderkey")
    U = F.col
    cibil = (F.lit(300) + F.floor(U("u_cibil") * 13) * 50).cast("int")
    ul = U("u_status")
    status = (F.when(ul < 0.002, F.lit(" Pending"))
              .when(cibil >= 550, F.when(ul < 0.9, " Approved").otherwise(" Rejected"))
              .otherwise(F.when(ul < 0.1, " Approved").otherwise(" Rejected")))
    return b.select(
        o.alias("loan_id"),
        F.floor(U("u_dependents2") * 6).cast("int").alias(" no_of_dependents"),
        F.when(F.col("c_mktsegment").isin(*GRADUATE_SEGMENTS), " Graduate")
         .otherwise(" Not Graduate").alias(" education"),
        F.when(U("u_self2") < 0.3, " Yes").otherwise(" No").alias(" self_employed"),
        ((F.floor(F.col("c_acctbal") / 1000.0) + 2) * 1000000.0).alias(" income_annum"),
        ((F.floor(F.col("o_totalprice") / 100000.0) + 1) * 1000000.0).alias(" loan_amount"),
        F.when(F.col("n_lines") > 4, F.lit(20)).otherwise(F.col("n_lines") * 5).cast("int")
         .alias(" loan_term"),
        cibil.alias(" cibil_score"),
        (F.floor(F.col("c_acctbal") / 2000.0) * 1000000.0).alias(" residential_assets_value"),
        (F.floor(U("u_commercial") * 4) * 1000000.0).alias(" commercial_assets_value"),
        (F.floor(F.col("c_acctbal") / 2500.0) * 2000000.0 + 1000000.0).alias(" luxury_assets_value"),
        (F.floor(U("u_bank") * 5) * 1000000.0).alias(" bank_asset_value"),
        status.alias(" loan_status"),
    )


# ---------------------------------------------------------------- DuckDB text

SQL_ORDER_BASE = """
order_base AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderpriority, o.o_orderdate,
         li.n_lines, li.disc_value, li.n_returned,
         c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, r.r_name
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines,
                    CAST(sum(floor(l_extendedprice * l_discount)) AS DOUBLE) AS disc_value,
                    count_if(l_returnflag = 'R') AS n_returned
             FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def _sql_draws() -> str:
    out = []
    for grp, key, salt in (("o1", "o_orderkey", "app1"), ("o2", "o_orderkey", "app2"),
                           ("c1", "c_custkey", "cust1"), ("c2", "c_custkey", "cust2")):
        names = _DRAWS[grp]
        out += [f"{u} AS {n}" for n, u in zip(names, hash_uniforms_sql(key, salt, len(names)))]
    return ",\n    ".join(out)


SQL_ORDER_BASE = SQL_ORDER_BASE.replace("order_base AS (", "order_base0 AS (") + f""",
order_base AS (
  SELECT *,
    {_sql_draws()}
  FROM order_base0
)"""


def _sql_v1() -> str:
    uo = uc = lambda s: "u_" + s
    segs = ", ".join(f"'{s}'" for s in GRADUATE_SEGMENTS)
    area = "CASE " + " ".join(f"WHEN r_name = '{k}' THEN '{v}'" for k, v in AREA_BY_REGION.items()) + " END"
    credit = (f"CASE WHEN n_lines IS NULL OR {uo('credit')} < 0.08 THEN CAST(NULL AS DOUBLE) "
              f"WHEN n_returned * 3 <= n_lines THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
    return f"""
app_v1_pre AS (
  SELECT *, {credit} AS credit_history_, {uo('label')} AS ul_ FROM order_base
),
applications_v1 AS (
  SELECT o_orderkey AS application_id,
    CASE WHEN {uc('gender')} < 0.18 THEN 'Female' WHEN {uc('gender')} < 0.98 THEN 'Male' END AS gender,
    CASE WHEN {uc('married')} < 0.35 THEN 'No' WHEN {uc('married')} < 0.995 THEN 'Yes' END AS married,
    CASE WHEN {uc('dependents')} < 0.57 THEN '0' WHEN {uc('dependents')} < 0.74 THEN '1'
         WHEN {uc('dependents')} < 0.90 THEN '2' WHEN {uc('dependents')} < 0.975 THEN '3+' END AS dependents,
    CASE WHEN c_mktsegment IN ({segs}) THEN 'Graduate' ELSE 'Not Graduate' END AS education,
    CASE WHEN {uo('self')} < 0.05 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS self_employed,
    c_acctbal AS applicant_income,
    disc_value AS coapplicant_income,
    CASE WHEN {uo('loan')} < 0.035 THEN CAST(NULL AS DOUBLE) ELSE o_totalprice / 1000.0 END AS loan_amount,
    CASE WHEN {uo('term')} < 0.02 THEN CAST(NULL AS DOUBLE) ELSE CAST(n_lines * 60 AS DOUBLE) END AS loan_amount_term,
    credit_history_ AS credit_history,
    {area} AS property_area,
    CASE WHEN credit_history_ = 1.0 THEN (CASE WHEN ul_ < 0.92 THEN 'Y' ELSE 'N' END)
         WHEN credit_history_ = 0.0 THEN (CASE WHEN ul_ < 0.06 THEN 'Y' ELSE 'N' END)
         ELSE (CASE WHEN ul_ < 0.6 THEN 'Y' ELSE 'N' END) END AS loan_status,
    CAST(o_orderdate AS DATE) AS applied_on
  FROM app_v1_pre
)"""


def _sql_v2() -> str:
    uo = uc = lambda s: "u_" + s
    segs = ", ".join(f"'{s}'" for s in GRADUATE_SEGMENTS)
    return f"""
app_v2_pre AS (
  SELECT *, CAST(300 + floor({uc('cibil')} * 13) * 50 AS INTEGER) AS cibil_, {uo('status')} AS us_
  FROM order_base
),
applications_v2_raw AS (
  SELECT o_orderkey AS loan_id,
    CAST(floor({uc('dependents2')} * 6) AS INTEGER) AS " no_of_dependents",
    CASE WHEN c_mktsegment IN ({segs}) THEN ' Graduate' ELSE ' Not Graduate' END AS " education",
    CASE WHEN {uo('self2')} < 0.3 THEN ' Yes' ELSE ' No' END AS " self_employed",
    (floor(c_acctbal / 1000.0) + 2) * 1000000.0 AS " income_annum",
    (floor(o_totalprice / 100000.0) + 1) * 1000000.0 AS " loan_amount",
    CAST(CASE WHEN n_lines > 4 THEN 20 ELSE n_lines * 5 END AS INTEGER) AS " loan_term",
    cibil_ AS " cibil_score",
    floor(c_acctbal / 2000.0) * 1000000.0 AS " residential_assets_value",
    floor({uc('commercial')} * 4) * 1000000.0 AS " commercial_assets_value",
    floor(c_acctbal / 2500.0) * 2000000.0 + 1000000.0 AS " luxury_assets_value",
    floor({uc('bank')} * 5) * 1000000.0 AS " bank_asset_value",
    CASE WHEN us_ < 0.002 THEN ' Pending'
         WHEN cibil_ >= 550 THEN (CASE WHEN us_ < 0.9 THEN ' Approved' ELSE ' Rejected' END)
         ELSE (CASE WHEN us_ < 0.1 THEN ' Approved' ELSE ' Rejected' END) END AS " loan_status"
  FROM app_v2_pre
)"""


SQL_APPLICATIONS_V1 = SQL_ORDER_BASE + "," + _sql_v1()
SQL_APPLICATIONS_V2_RAW = SQL_ORDER_BASE + "," + _sql_v2()
SQL_APPLICATIONS_BOTH = SQL_ORDER_BASE + "," + _sql_v1() + "," + _sql_v2()
