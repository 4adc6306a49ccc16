"""Report queries over the scored frame: segments, trends, funnel, queue,
case records, summaries.  Spark plans and their DuckDB oracle text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import policy as pol
from ..operators import profile as pr
from ..operators import queue as q
from ..operators import segments as seg
from ..operators import toplists as tops
from ..sources.tables import read_table
from .analysis_frame import ROUTE_MANUAL, analysis_frame, analysis_frame_sql, route_sql
from .fixtures import V1_COLUMNS, applications_v1
from .policy_queries import _policies_values, brute_policy_sql
from .scorecard_queries import importance_rollup, sql_importance_rollup

QUEUE_SEARCH = "analyst b"
ALL_DIMS = list(seg.DIMENSIONS)
CASE_MODEL, CASE_MODEL_VERSION = "scorecard_v1", "1"


# ------------------------------------------------------------------ Spark

def segment_kpis_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seg.segment_metrics(analysis_frame(spark, sf_dir), "channel").drop("dimension")


def segment_kpis_all_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seg.segment_metrics(analysis_frame(spark, sf_dir), ALL_DIMS)


def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seg.daily_trend(analysis_frame(spark, sf_dir))


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seg.funnel(analysis_frame(spark, sf_dir))


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.review_queue(analysis_frame(spark, sf_dir), 0.75, 0.25, q.QUEUE_DEFAULT_LIMIT)


def queue_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The searched queue under every preset."""
    return q.preset_queues(analysis_frame(spark, sf_dir), search=QUEUE_SEARCH)


def priority_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = analysis_frame(spark, sf_dir)
    return f.select(
        "application_id", F.col("missing_fields").cast("long").alias("missing_fields"), "channel",
        F.round("document_completeness", 6).alias("document_completeness"),
        F.round("uncertainty", 6).alias("uncertainty"),
        F.round("processing_hours", 6).alias("processing_hours"),
        "sla_hours", "sla_breached",
        F.round("estimated_review_minutes", 6).alias("estimated_review_minutes"),
        F.round("exposure_norm", 6).alias("exposure_norm"),
        F.round("priority_score", 6).alias("priority_score"),
        "priority_reason", "analyst", "simulation_day", "created_at")


def case_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user id seen in ``events`` is looked up as an application id."""
    req = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("application_id"))
    return q.case_records(analysis_frame(spark, sf_dir), req)


def case_records_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = case_records(spark, sf_dir).where("found").drop("found")
    n = q.case_record_nested(flat, CASE_MODEL, CASE_MODEL_VERSION)
    return n.select("application_id", "priority_reason", "applicant.property_area", F.col("applicant.loan_amount_thousands"),
                    "audit.model", "audit.model_version", "audit.source_target",
                    F.array_join("audit.simulation_fields", ",").alias("simulation_fields"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are asked for: users of events, and twice the event number, a range that goes
    beyond the applications."""
    asked = F.array(F.col("user_id").cast("long"), F.col("event_id").cast("long") * 2)
    return read_table(spark, sf_dir, "events").select(F.explode(asked).alias("application_id")).distinct()


def cases_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids that no application has (the anti-join form of the lookup)."""
    return _requests(spark, sf_dir).join(analysis_frame(spark, sf_dir).select("application_id"), "application_id", "left_anti")


def decision_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications and share of every route."""
    g = analysis_frame(spark, sf_dir).groupBy(F.col("baseline_route").alias("route")).agg(
        F.count(F.lit(1)).alias("applications"))
    total = g.agg(F.sum("applications").alias("_t"))
    return g.crossJoin(F.broadcast(total)).select(
        "route", "applications", F.round(F.col("applications") / F.col("_t"), 6).alias("share"))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_summary(analysis_frame(spark, sf_dir))


def frame_summary(f: DataFrame) -> DataFrame:
    return f.agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_if(F.col("historical_approved")).alias("historical_approvals"),
        F.round(F.avg(F.col("historical_approved").cast("double")), 6).alias("historical_approval_rate"),
        F.round(F.sum("loan_value"), 2).alias("loan_value"),
        F.round(F.avg("processing_hours"), 2).alias("avg_processing_hours"),
        F.round(F.avg(F.col("sla_breached").cast("double")), 6).alias("sla_breach_rate"),
        F.round(F.avg("document_completeness"), 6).alias("document_completeness"))


def reporting_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = analysis_frame(spark, sf_dir)
    d = F.to_date("simulation_day")
    a = f.agg(F.min(d).alias("s"), F.max(d).alias("e"))
    return a.select(F.date_format("s", "yyyy-MM-dd").alias("period_start"),
                    F.date_format("e", "yyyy-MM-dd").alias("period_end"),
                    (F.datediff("e", "s") + 1).cast("long").alias("period_days"))


def _f(x, digits):
    return F.format_string(f"%.{digits}f", F.round(x, digits))


def analysis_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_sentences(analysis_frame(spark, sf_dir))


def summary_sentences(f: DataFrame, approve: float = 0.75, reject: float = 0.25, analysts: int = 1,
                      productive_hours: float = 6.0, volume_multiplier: float = 1.0,
                      dimension: str = "channel") -> DataFrame:
    """Three or four sentences from the KPIs of a policy, the top segment of
    a dimension and the count of high-priority cases (one-row plans, stacked)."""
    k = pol.policy_metrics(f, approve, reject, analysts, productive_hours, volume_multiplier)
    segs = seg.segment_metrics(f, dimension, approve, reject)
    top = segs.agg(F.min_by(F.struct("segment", "manual_review_rate", "avg_processing_hours"),
                            F.struct(-F.col("opportunity_score"), -F.col("applications"), "segment")).alias("t"))
    hp = f.agg(F.count_if(F.col("priority_score") >= q.HIGH_PRIORITY).alias("high_priority"))
    one = k.crossJoin(top).crossJoin(hp)
    s1 = F.concat(F.lit(f"At thresholds {approve:g} / {reject:g}, "), _f(F.col("auto_decision_rate") * 100, 1),
                  F.lit("% of applications are decided automatically, agreeing with the recorded decision in "),
                  _f(F.col("auto_historical_agreement") * 100, 1), F.lit("% of those cases; "),
                  _f(F.col("manual_review_rate") * 100, 1), F.lit("% need a reviewer."))
    s2 = (F.when(F.col("capacity_status") == "Over capacity",
                 F.concat(F.lit("Reviewers are over capacity: the backlog grows by about "),
                          _f(F.col("backlog_growth_cases_per_day"), 1), F.lit(" cases a day.")))
          .when(F.col("capacity_status") == "Tight",
                F.concat(F.lit("Review capacity is tight: staffing covers about "),
                         _f(F.col("max_sustainable_volume_multiplier"), 2),
                         F.lit("x of current demand before a backlog builds.")))
          .otherwise(F.concat(F.lit("Review capacity is healthy at "),
                              _f(F.col("capacity_utilization") * 100, 0),
                              F.lit("% utilisation, enough for about "),
                              _f(F.col("max_sustainable_volume_multiplier"), 2),
                              F.lit("x of current demand."))))
    s3 = F.when(F.col("t").isNotNull(), F.concat(
        F.lit(f"Top improvement candidate: {dimension} "), F.col("t.segment"), F.lit(" with "),
        _f(F.col("t.manual_review_rate") * 100, 1), F.lit("% manual review and "),
        _f(F.col("t.avg_processing_hours"), 1), F.lit(" h average processing time.")))
    s4 = F.concat(F.col("high_priority").cast("string"),
                  F.lit(" cases score 70 or more on the priority scale."))
    rows = F.array(F.struct(F.lit(1).alias("seq"), s1.alias("sentence")),
                   F.struct(F.lit(2).alias("seq"), s2.alias("sentence")),
                   F.struct(F.lit(3).alias("seq"), s3.alias("sentence")),
                   F.struct(F.lit(4).alias("seq"), s4.alias("sentence")))
    return (one.select(F.explode(rows).alias("r")).select("r.seq", "r.sentence")
            .where(F.col("sentence").isNotNull()))


def segment_narrative(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = seg.segment_metrics(analysis_frame(spark, sf_dir), "channel")
    # the segment table has one row per channel value: a bounded window
    w = Window.orderBy(F.col("opportunity_score").desc(), F.col("applications").desc(), F.col("segment"))
    r = segs.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= 2)
    a = r.agg(F.max(F.when(F.col("rk") == 1, F.col("segment"))).alias("s1"),
              F.max(F.when(F.col("rk") == 1, F.col("opportunity_score"))).alias("o1"),
              F.max(F.when(F.col("rk") == 2, F.col("segment"))).alias("s2"),
              F.max(F.when(F.col("rk") == 2, F.col("opportunity_score"))).alias("o2"))
    text = F.concat(F.col("s1"), F.lit(" leads with opportunity score "), _f(F.col("o1"), 4),
                    F.when(F.col("s2").isNotNull(),
                           F.concat(F.lit("; next is "), F.col("s2"), F.lit(" at "), _f(F.col("o2"), 4)))
                     .otherwise(F.lit("")), F.lit("."))
    return a.where(F.col("s1").isNotNull()).select(text.alias("narrative"))


# Sizes of the report's lists.
LIST_SIZES = {"opportunities": 4, "segment_cards": 3, "missing_fields": 6, "importances": 10}
LIST_FLOORS = {"missing_fields": 1.0, "importances": 0.001}
LIST_DIMENSIONS = {"opportunities": "channel", "segment_cards": "property_area"}


def top_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four fixed-size lists: segments by opportunity (of two dimensions), fields by missing
    values, features by the scorecard's rolled-up importance."""
    f = analysis_frame(spark, sf_dir)
    parts = []
    for name, dimension in LIST_DIMENSIONS.items():
        segs = seg.segment_metrics(f, dimension)
        detail = F.concat(F.format_string("%.6f", "manual_review_rate"), F.lit(" manual, "),
                          F.format_string("%.2f", "avg_processing_hours"), F.lit(" h"))
        parts.append(tops.entries(segs, name, F.col("segment"), F.col("opportunity_score"), F.col("applications"),
                                  value=F.col("applications"), detail=detail))
    missing = pr.missing_by_field(applications_v1(spark, sf_dir))
    parts.append(tops.entries(missing, "missing_fields", F.col("field"), value=F.col("missing")))
    parts.append(tops.entries(importance_rollup(spark, sf_dir), "importances", F.col("feature"), value=F.col("importance")))
    return tops.top_lists(parts, LIST_SIZES, LIST_FLOORS)


# ------------------------------------------------------------------ DuckDB

def sql_top_lists() -> str:
    segments = ", ".join(f"""
  l_{name} AS (SELECT '{name}' AS list, segment AS label, CAST(applications AS DOUBLE) AS value,
    printf('%.6f', manual_review_rate) || ' manual, ' || printf('%.2f', avg_processing_hours) || ' h' AS detail,
    opportunity_score AS k1, applications AS k2 FROM segs WHERE dimension = '{dimension}')"""
                         for name, dimension in LIST_DIMENSIONS.items())
    fields = " UNION ALL ".join(f"SELECT '{c}' AS label, count_if({c} IS NULL) AS n FROM applications_v1" for c in V1_COLUMNS)
    sizes = " ".join(f"WHEN '{name}' THEN {k}" for name, k in LIST_SIZES.items())
    floors = " ".join(f"WHEN '{name}' THEN {v!r}" for name, v in LIST_FLOORS.items())
    return "WITH " + analysis_frame_sql() + "," + _segments_sql(list(LIST_DIMENSIONS.values())) + "," + segments + f""",
  l_missing AS (SELECT 'missing_fields' AS list, label, CAST(n AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail, n AS k1,
    0 AS k2 FROM ({fields}) WHERE n > 0),
  l_importance AS (SELECT 'importances' AS list, feature AS label, CAST(importance AS DOUBLE) AS value,
    CAST(NULL AS VARCHAR) AS detail, importance AS k1, 0 AS k2 FROM ({sql_importance_rollup()})),
  lists AS ({" UNION ALL ".join(f"SELECT * FROM l_{n}" for n in (*LIST_DIMENSIONS, "missing", "importance"))}),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY list ORDER BY k1 DESC, k2 DESC, label) AS INTEGER) AS rank,
    round(greatest(0.0, value) / greatest(max(value) OVER (PARTITION BY list), CASE list {floors} ELSE 1.0 END), 6)
      AS relative_to_max FROM lists)
SELECT list, rank, label, value, relative_to_max, detail FROM ranked WHERE rank <= CASE list {sizes} END"""


def _label_sql(d: str) -> str:
    c = seg.DIMENSIONS[d]
    if d == "credit_history":
        c = f"CAST(CAST({c} AS INTEGER) AS VARCHAR)"
    return f"coalesce(CAST({c} AS VARCHAR), 'Missing')"


def _rate(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)"


def _segments_sql(dims, name="segs") -> str:
    rt = route_sql("approval_probability", 0.75, 0.25)
    parts = []
    for d in dims:
        parts.append(f"""
  SELECT '{d}' AS dimension, {_label_sql(d)} AS segment, count(*) AS applications,
    {_rate('historical_approved')} AS hist_, {_rate(f"rt = '{ROUTE_MANUAL}'")} AS manual_,
    count_if(rt <> '{ROUTE_MANUAL}') AS auto_,
    count_if(rt <> '{ROUTE_MANUAL}' AND ((rt = 'Auto approve') = historical_approved)) AS agree_,
    avg(processing_hours) AS tat_, {_rate('sla_breached')} AS breach_,
    avg(document_completeness) AS compl_, sum(loan_value) AS value_
  FROM routed GROUP BY 1, 2""")
    return f"""
routed AS (SELECT *, {rt} AS rt FROM analysis),
overall AS (SELECT count(*) AS n_, {_rate(f"rt = '{ROUTE_MANUAL}'")} AS om_, avg(processing_hours) AS otat_ FROM routed),
{name}_g AS ({" UNION ALL ".join(parts)}),
{name} AS (
  SELECT dimension, segment, CAST(applications AS BIGINT) AS applications,
    round(applications / n_, 6) AS volume_share,
    round(hist_, 6) AS historical_approval_rate,
    round(manual_, 6) AS manual_review_rate,
    round(CASE WHEN auto_ > 0 THEN agree_ / auto_ ELSE 1.0 END, 6) AS auto_historical_agreement,
    round(tat_, 2) AS avg_processing_hours,
    round(breach_, 6) AS sla_breach_rate,
    round(compl_, 6) AS document_completeness,
    round(value_, 2) AS loan_value,
    round(applications / n_ * greatest(0.0, manual_ - om_ + 0.15) * greatest(0.0, tat_ / greatest(otat_, 0.1)), 6)
      AS opportunity_score
  FROM {name}_g CROSS JOIN overall
)"""


def sql_segment_kpis_channel() -> str:
    return "WITH " + analysis_frame_sql() + "," + _segments_sql(["channel"]) + \
        "\nSELECT * EXCLUDE (dimension) FROM segs"


def sql_segment_kpis_all_dims() -> str:
    return "WITH " + analysis_frame_sql() + "," + _segments_sql(ALL_DIMS) + "\nSELECT * FROM segs"


def sql_daily_trend() -> str:
    rt = route_sql("approval_probability", 0.75, 0.25)
    return "WITH " + analysis_frame_sql() + f"""
SELECT simulation_day AS date, count(*) AS applications,
  round({_rate('historical_approved')}, 6) AS historical_approval_rate,
  round({_rate(f"{rt} = '{ROUTE_MANUAL}'")}, 6) AS manual_review_rate,
  round({_rate('sla_breached')}, 6) AS sla_breach_rate,
  round(avg(processing_hours), 2) AS avg_processing_hours,
  round({_rate("channel = 'Digital'")}, 6) AS digital_share
FROM analysis WHERE simulation_day IS NOT NULL GROUP BY simulation_day"""


def sql_funnel() -> str:
    rt = route_sql("approval_probability", 0.75, 0.25)
    st = seg.FUNNEL_STAGES
    return "WITH " + analysis_frame_sql() + f""",
c AS (SELECT count(*) AS n0, count_if(document_completeness >= 0.90) AS n1,
             count_if({rt} <> '{ROUTE_MANUAL}') AS n2, count_if({rt} = '{ROUTE_MANUAL}') AS n3,
             count_if(historical_approved) AS n4 FROM analysis),
f AS (
SELECT 1 AS stage_order, '{st[0]}' AS stage, CAST(n0 AS BIGINT) AS count, 1.0::DOUBLE AS rate FROM c
UNION ALL SELECT 2, '{st[1]}', n1, round(n1 / n0, 6) FROM c
UNION ALL SELECT 3, '{st[2]}', n2, round(n2 / n0, 6) FROM c
UNION ALL SELECT 4, '{st[3]}', n3, round(n3 / n0, 6) FROM c
UNION ALL SELECT 5, '{st[4]}', n4, round(n4 / n0, 6) FROM c)
SELECT *, round(count / greatest(max(count) OVER (), 1), 6) AS relative_to_max FROM f"""


_QUEUE_COLUMNS = """application_id, round(policy_priority, 1) AS priority, priority_reason,
    round(approval_probability, 6) AS approval_probability, round(loan_value, 2) AS loan_value,
    channel, property_area, round(document_completeness, 6) AS document_completeness,
    round(processing_hours, 2) AS processing_hours, sla_breached, analyst,
    CASE WHEN historical_approved THEN 'Approved' ELSE 'Rejected' END AS historical_outcome"""


def _queue_sql(limit: int) -> str:
    rt = route_sql("approval_probability", 0.75, 0.25)
    return f"""
manual AS (SELECT * FROM analysis WHERE {rt} = '{ROUTE_MANUAL}'),
ranked AS (
  SELECT *, (rank() OVER (ORDER BY loan_value) + (count(*) OVER (PARTITION BY loan_value) - 1) / 2.0)
            / count(loan_value) OVER () AS value_pct
  FROM manual
),
pq AS (
  SELECT *, {_clip('(priority_score + value_pct * 8.0 + ' + _clip('(processing_hours / 24.0)', 0.0, 2.0) + ' * 6.0)', 0.0, 100.0)}
            AS policy_priority
  FROM ranked
),
queue AS (
  SELECT {_QUEUE_COLUMNS}
  FROM pq
  ORDER BY policy_priority DESC, pq.processing_hours DESC, pq.loan_value DESC, application_id ASC
  LIMIT {limit}
)"""


def _clip(x, lo, hi):
    from ..functions.columns import clip_sql
    return clip_sql(x, lo, hi)


def sql_review_queue() -> str:
    return "WITH " + analysis_frame_sql() + "," + _queue_sql(q.QUEUE_DEFAULT_LIMIT) + "\nSELECT * FROM queue"


def sql_queue_filters() -> str:
    text = "lower(concat_ws(' ', CAST(application_id AS VARCHAR), channel, priority_reason, property_area, analyst))"
    presets = {"all": "true", "high_priority": "round(policy_priority, 1) >= 70.0", "sla_breached": "sla_breached",
               "document_friction": "priority_reason = 'Document friction'"}
    parts = [f"""SELECT * FROM (SELECT '{name}' AS preset, {_QUEUE_COLUMNS},
  CASE WHEN round(policy_priority, 1) >= 70.0 THEN 'high' WHEN round(policy_priority, 1) >= 50.0 THEN 'medium'
       ELSE 'low' END AS priority_band
  FROM pq WHERE contains({text}, '{QUEUE_SEARCH.lower()}') AND {cond}
  ORDER BY policy_priority DESC, pq.processing_hours DESC, pq.loan_value DESC, application_id ASC
  LIMIT {q.QUEUE_DEFAULT_LIMIT})""" for name, cond in presets.items()]
    return "WITH " + analysis_frame_sql() + "," + _queue_sql(1) + "\n" + "\nUNION ALL\n".join(parts)


def sql_priority_scores() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT application_id, CAST(missing_fields AS BIGINT) AS missing_fields, channel,
  round(document_completeness, 6) AS document_completeness, round(uncertainty, 6) AS uncertainty,
  round(processing_hours, 6) AS processing_hours, sla_hours, sla_breached,
  round(estimated_review_minutes, 6) AS estimated_review_minutes, round(exposure_norm, 6) AS exposure_norm,
  round(priority_score, 6) AS priority_score, priority_reason, analyst, simulation_day, created_at
FROM analysis"""


def sql_case_records() -> str:
    return "WITH " + analysis_frame_sql() + """,
req AS (SELECT DISTINCT user_id AS application_id FROM events)
SELECT r.application_id,
  CASE WHEN a.application_id IS NULL THEN NULL WHEN a.historical_approved THEN 'Approved' ELSE 'Rejected' END
    AS historical_outcome,
  round(a.approval_probability, 6) AS approval_probability, a.baseline_route,
  round(a.priority_score, 1) AS priority_score, a.priority_reason, a.channel, a.analyst,
  round(a.processing_hours, 2) AS processing_hours, round(a.sla_hours, 2) AS sla_hours, a.sla_breached,
  round(a.document_completeness, 6) AS document_completeness, round(a.loan_value, 2) AS loan_value,
  a.married AS applicant_married, a.dependents AS applicant_dependents, a.education AS applicant_education,
  a.self_employed AS applicant_self_employed,
  CASE WHEN a.application_id IS NULL THEN NULL WHEN a.applicant_income IS NULL OR isnan(a.applicant_income) OR isinf(a.applicant_income) THEN 0.0 ELSE a.applicant_income END AS applicant_income,
  CASE WHEN a.application_id IS NULL THEN NULL WHEN a.coapplicant_income IS NULL OR isnan(a.coapplicant_income) OR isinf(a.coapplicant_income) THEN 0.0 ELSE a.coapplicant_income END AS applicant_coapplicant_income,
  CASE WHEN a.application_id IS NULL THEN NULL WHEN a.loan_amount IS NULL OR isnan(a.loan_amount) OR isinf(a.loan_amount) THEN 0.0 ELSE a.loan_amount END AS applicant_loan_amount_thousands,
  CASE WHEN a.application_id IS NULL THEN NULL WHEN a.loan_amount_term IS NULL OR isnan(a.loan_amount_term) OR isinf(a.loan_amount_term) THEN 0.0 ELSE a.loan_amount_term END AS applicant_loan_amount_term_months,
  CAST(a.credit_history AS INTEGER) AS applicant_credit_history, a.property_area AS applicant_property_area,
  a.application_id IS NOT NULL AS found
FROM req r LEFT JOIN analysis a ON r.application_id = a.application_id"""


def sql_case_records_nested() -> str:
    return "WITH flat AS (" + sql_case_records() + f""")
SELECT application_id, priority_reason, applicant_property_area AS property_area,
  applicant_loan_amount_thousands AS loan_amount_thousands, '{CASE_MODEL}' AS model,
  '{CASE_MODEL_VERSION}' AS model_version, 'historical loan approval' AS source_target,
  'channel,created_at,analyst,processing_hours,sla_hours' AS simulation_fields
FROM flat WHERE found"""


def sql_cases_not_found() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT DISTINCT application_id FROM (SELECT user_id AS application_id FROM events UNION ALL SELECT 2 * event_id FROM events) e
WHERE NOT EXISTS (SELECT 1 FROM analysis a WHERE a.application_id = e.application_id)"""


def sql_decision_mix() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT baseline_route AS route, count(*) AS applications,
  round(count(*) / (SELECT count(*) FROM analysis), 6) AS share FROM analysis GROUP BY 1"""


def sql_dataset_summary() -> str:
    return "WITH " + analysis_frame_sql() + f"""
SELECT count(*) AS applications, count_if(historical_approved) AS historical_approvals,
  round({_rate('historical_approved')}, 6) AS historical_approval_rate,
  round(sum(loan_value), 2) AS loan_value, round(avg(processing_hours), 2) AS avg_processing_hours,
  round({_rate('sla_breached')}, 6) AS sla_breach_rate,
  round(avg(document_completeness), 6) AS document_completeness
FROM analysis"""


def sql_reporting_period() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT strftime(min(CAST(simulation_day AS DATE)), '%Y-%m-%d') AS period_start,
       strftime(max(CAST(simulation_day AS DATE)), '%Y-%m-%d') AS period_end,
       CAST(date_diff('day', min(CAST(simulation_day AS DATE)), max(CAST(simulation_day AS DATE))) + 1 AS BIGINT)
         AS period_days
FROM analysis"""


def _p(x, d):
    return f"printf('%.{d}f', round({x}, {d}))"


def sql_analysis_summary() -> str:
    k = brute_policy_sql(_policies_values([(0, 0.75, 0.25, 1, 6.0, 1.0)]))
    return "WITH " + analysis_frame_sql() + "," + k + "," + _segments_sql(["channel"]) + f""",
top AS (SELECT segment, manual_review_rate AS top_manual, avg_processing_hours AS top_hours FROM segs
        ORDER BY opportunity_score DESC, applications DESC, segment ASC LIMIT 1),
hp AS (SELECT count_if(priority_score >= 70.0) AS high_priority FROM analysis),
one AS (SELECT * FROM kpis CROSS JOIN hp LEFT JOIN top ON true)
SELECT 1 AS seq, 'At thresholds 0.75 / 0.25, ' || {_p('auto_decision_rate * 100', 1)}
  || '% of applications are decided automatically, agreeing with the recorded decision in '
  || {_p('auto_historical_agreement * 100', 1)} || '% of those cases; '
  || {_p('manual_review_rate * 100', 1)} || '% need a reviewer.' AS sentence FROM one
UNION ALL
SELECT 2, CASE WHEN capacity_status = 'Over capacity'
    THEN 'Reviewers are over capacity: the backlog grows by about ' || {_p('backlog_growth_cases_per_day', 1)} || ' cases a day.'
  WHEN capacity_status = 'Tight'
    THEN 'Review capacity is tight: staffing covers about ' || {_p('max_sustainable_volume_multiplier', 2)} || 'x of current demand before a backlog builds.'
  ELSE 'Review capacity is healthy at ' || {_p('capacity_utilization * 100', 0)} || '% utilisation, enough for about '
    || {_p('max_sustainable_volume_multiplier', 2)} || 'x of current demand.' END FROM one
UNION ALL
SELECT 3, 'Top improvement candidate: channel ' || segment || ' with ' || {_p('top_manual * 100', 1)}
  || '% manual review and ' || {_p('top_hours', 1)} || ' h average processing time.' FROM one
  WHERE segment IS NOT NULL
UNION ALL
SELECT 4, CAST(high_priority AS VARCHAR) || ' cases score 70 or more on the priority scale.' FROM one"""


def sql_segment_narrative() -> str:
    return "WITH " + analysis_frame_sql() + "," + _segments_sql(["channel"]) + f""",
r AS (SELECT *, row_number() OVER (ORDER BY opportunity_score DESC, applications DESC, segment ASC) AS rk FROM segs),
a AS (SELECT max(CASE WHEN rk = 1 THEN segment END) AS s1, max(CASE WHEN rk = 1 THEN opportunity_score END) AS o1,
             max(CASE WHEN rk = 2 THEN segment END) AS s2, max(CASE WHEN rk = 2 THEN opportunity_score END) AS o2
      FROM r WHERE rk <= 2)
SELECT s1 || ' leads with opportunity score ' || {_p('o1', 4)}
  || CASE WHEN s2 IS NOT NULL THEN '; next is ' || s2 || ' at ' || {_p('o2', 4)} ELSE '' END || '.' AS narrative
FROM a WHERE s1 IS NOT NULL"""


QUERIES = {
    "segment_kpis_channel": (segment_kpis_channel, sql_segment_kpis_channel),
    "segment_kpis_all_dims": (segment_kpis_all_dims, sql_segment_kpis_all_dims),
    "daily_trend": (daily_trend, sql_daily_trend),
    "funnel": (funnel, sql_funnel),
    "review_queue": (review_queue, sql_review_queue),
    "queue_filters": (queue_filters, sql_queue_filters),
    "priority_scores": (priority_scores, sql_priority_scores),
    "case_records": (case_records, sql_case_records),
    "case_records_nested": (case_records_nested, sql_case_records_nested),
    "cases_not_found": (cases_not_found, sql_cases_not_found),
    "decision_mix": (decision_mix, sql_decision_mix),
    "dataset_summary": (dataset_summary, sql_dataset_summary),
    "reporting_period": (reporting_period, sql_reporting_period),
    "analysis_summary": (analysis_summary, sql_analysis_summary),
    "segment_narrative": (segment_narrative, sql_segment_narrative),
    "top_lists": (top_lists, sql_top_lists),
}
