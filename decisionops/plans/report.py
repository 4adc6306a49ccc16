"""Full scenario report (C3): every section of the decision report over one
materialised scored frame, returned as named DataFrames (each a lazy plan;
the caller writes or collects what it needs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import policy as pol
from ..operators import profile as pr
from ..operators import queue as q
from ..operators import segments as seg
from ..operators.validate import scenario_violations
from . import data_queries as dq
from . import policy_queries as pq
from . import report_queries as rq
from .analysis_frame import analysis_frame
from .fixtures import applications_v1
from .report_queries import frame_summary, summary_sentences


def business_analysis_report(spark: SparkSession, sf_dir: str, approve: float = 0.75, reject: float = 0.25,
                             analysts: int = 1, productive_hours: float = 6.0, volume_multiplier: float = 1.0,
                             segment_dimension: str = "channel", guardrail: float = pol.DEFAULT_GUARDRAIL
                             ) -> dict[str, DataFrame]:
    scen = spark.createDataFrame([(approve, reject, analysts, productive_hours, volume_multiplier,
                                   segment_dimension)],
                                 "approve_threshold double, reject_threshold double, analysts int, "
                                 "productive_hours double, volume_multiplier double, segment_dimension string")
    bad = scenario_violations(scen).where(~F.col("valid")).select("violations").collect()   # one row
    if bad:
        raise ValueError(f"invalid scenario: {bad[0][0]}")
    f = analysis_frame(spark, sf_dir)
    d = F.to_date("simulation_day")
    return {
        "summary": summary_sentences(f, approve, reject, analysts, productive_hours, volume_multiplier, segment_dimension),
        "dataset_summary": frame_summary(f),
        "policy": pol.policy_metrics(f, approve, reject, analysts, productive_hours, volume_multiplier),
        "optimized_policy": pol.optimize_policy(f, guardrail, analysts, productive_hours, volume_multiplier),
        "funnel": seg.funnel(f, approve, reject),
        "trends": seg.daily_trend(f, approve, reject),
        "segments": seg.segment_metrics(f, segment_dimension, approve, reject).drop("dimension"),
        "queue": q.review_queue(f, approve, reject),
        "data_quality": pr.quality_profile(applications_v1(spark, sf_dir), "application_id",
                                           F.trim(F.col("loan_status")) == "Y"),
        "missing_by_field": pr.missing_by_field(applications_v1(spark, sf_dir)),
        "period": f.agg(F.min(d).alias("start"), F.max(d).alias("end"))
                   .select("start", "end", (F.datediff("end", "start") + 1).alias("days")),
    }


_KPIS = ["applications", "auto_approve", "auto_reject", "manual_review", "auto_decision_rate", "manual_review_rate",
         "auto_historical_agreement", "historical_approval_auto_capture", "historical_rejection_auto_capture",
         "auto_approved_value", "manual_review_value", "estimated_review_hours", "manual_everything_hours",
         "analyst_hours_saved", "capacity_utilization", "required_analyst_fte", "max_sustainable_volume_multiplier",
         "daily_manual_cases", "daily_case_capacity", "backlog_growth_cases_per_day"]
_SEGMENT = ["applications", "volume_share", "historical_approval_rate", "manual_review_rate", "auto_historical_agreement",
            "avg_processing_hours", "sla_breach_rate", "document_completeness", "loan_value", "opportunity_score"]
# section -> (column that names an item, its numbers, oracle of the same section at the default scenario)
SECTIONS = {
    "dataset_summary": (None, ["applications", "historical_approvals", "historical_approval_rate", "loan_value",
                               "avg_processing_hours", "sla_breach_rate", "document_completeness"], rq.sql_dataset_summary),
    "policy": (None, _KPIS, pq.sql_policy_kpis_baseline),
    "optimized_policy": (None, ["approve_threshold", "reject_threshold", *_KPIS], pq.sql_policy_optimum),
    "funnel": ("stage", ["count", "rate", "relative_to_max"], rq.sql_funnel),
    "trends": ("date", ["applications", "historical_approval_rate", "manual_review_rate", "sla_breach_rate",
                        "avg_processing_hours", "digital_share"], rq.sql_daily_trend),
    "segments": ("segment", _SEGMENT, rq.sql_segment_kpis_channel),
    "queue": ("application_id", ["priority", "approval_probability", "loan_value", "document_completeness",
                                 "processing_hours"], rq.sql_review_queue),
    "data_quality": (None, ["rows", "columns", "duplicate_rows", "duplicate_ids", "missing_cells",
                            "historical_approval_rate"], dq.sql_quality_profile),
    "missing_by_field": ("field", ["missing", "rate"], dq.sql_missing_by_field),
}


def scenario_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the default scenario in long form: the numbers of every section as
    (section, item, field, value), and the sentences of the summary as text."""
    report = business_analysis_report(spark, sf_dir)
    out = report["summary"].select(F.lit("summary").alias("section"), F.col("seq").cast("string").alias("item"),
                                   F.lit("sentence").alias("field"), F.lit(None).cast("double").alias("value"),
                                   F.col("sentence").alias("text"))
    for section, (item, fields, _) in SECTIONS.items():
        cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in fields])
        name = F.col(item).cast("string") if item else F.lit("")
        out = out.unionByName(report[section].select(F.lit(section).alias("section"), name.alias("item"),
                                                     F.explode(cells).alias("c"))
                              .select("section", "item", "c.field", "c.value", F.lit(None).cast("string").alias("text")))
    return out


def sql_scenario_report() -> str:
    parts = [f"SELECT 'summary' AS section, CAST(seq AS VARCHAR) AS item, 'sentence' AS field, CAST(NULL AS DOUBLE) AS value, "
             f"sentence AS text FROM ({rq.sql_analysis_summary()})"]
    for section, (item, fields, sql) in SECTIONS.items():
        cells = ", ".join(f"{{'field': '{c}', 'value': CAST({c} AS DOUBLE)}}" for c in fields)
        name = f"CAST({item} AS VARCHAR)" if item else "''"
        parts.append(f"""SELECT '{section}', item, c.field, c.value, NULL FROM (
  SELECT {name} AS item, unnest([{cells}]) AS c FROM ({sql()}))""")
    return "\nUNION ALL ".join(parts)


QUERIES = {"scenario_report": (scenario_report, sql_scenario_report)}
