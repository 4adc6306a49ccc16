"""Segment, trend and funnel aggregates over the scored frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rate
from ..plans.analysis_frame import ROUTE_APPROVE, ROUTE_MANUAL, route

# Segment dimensions that may be requested (name -> column).
DIMENSIONS = {
    "channel": "channel",
    "property_area": "property_area",
    "education": "education",
    "self_employed": "self_employed",
    "credit_history": "credit_history",
}
FUNNEL_STAGES = ["Applications received", "Documents ≥90% complete", "Auto decision eligible",
                 "Manual review", "Historical approvals"]


def segment_label(dimension: str) -> Column:
    if dimension not in DIMENSIONS:
        raise ValueError(f"Unsupported dimension: {dimension}")
    c = F.col(DIMENSIONS[dimension])
    if dimension == "credit_history":
        c = c.cast("int").cast("string")
    return F.coalesce(c.cast("string"), F.lit("Missing"))


def _with_route(frame: DataFrame, approve: float, reject: float) -> DataFrame:
    return frame.withColumn("policy_route", route("approval_probability", approve, reject))


def segment_metrics(frame: DataFrame, dimensions, approve: float = 0.75,
                    reject: float = 0.25) -> DataFrame:
    """One row per (dimension, segment) for every requested dimension, in a
    single aggregation: each row is expanded to one (dimension, segment)
    pair per dimension before the partial aggregate (like grouping sets),
    so a null member stays its own 'Missing' group."""
    dims = [dimensions] if isinstance(dimensions, str) else list(dimensions)
    for d in dims:
        segment_label(d)
    w = _with_route(frame, approve, reject)
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), segment_label(d).alias("segment"))
                                for d in dims]))
    manual = F.col("policy_route") == ROUTE_MANUAL
    auto = ~manual
    agree = auto & ((F.col("policy_route") == ROUTE_APPROVE) == F.col("historical_approved"))
    x = w.select(pairs.alias("g"), manual.alias("m"), auto.alias("a"), agree.alias("ag"),
                 "historical_approved", "processing_hours", "sla_breached", "document_completeness",
                 "loan_value")
    g = x.groupBy(F.col("g.dimension").alias("dimension"), F.col("g.segment").alias("segment")).agg(
        F.count(F.lit(1)).alias("applications"),
        rate(F.col("historical_approved")).alias("_hist"),
        rate(F.col("m")).alias("_manual"),
        F.count_if(F.col("a")).alias("_auto"), F.count_if(F.col("ag")).alias("_agree"),
        F.avg("processing_hours").alias("_tat"),
        rate(F.col("sla_breached")).alias("_breach"),
        F.avg("document_completeness").alias("_compl"),
        F.sum("loan_value").alias("_value"))
    overall = w.agg(F.count(F.lit(1)).alias("_n"), rate(manual).alias("_om"),
                    F.avg("processing_hours").alias("_otat"))
    g = g.crossJoin(F.broadcast(overall))
    share = F.col("applications") / F.col("_n")
    score = (share * F.greatest(F.lit(0.0), F.col("_manual") - F.col("_om") + 0.15)
             * F.greatest(F.lit(0.0), F.col("_tat") / F.greatest(F.col("_otat"), F.lit(0.1))))
    return g.select(
        "dimension", "segment", "applications",
        F.round(share, 6).alias("volume_share"),
        F.round("_hist", 6).alias("historical_approval_rate"),
        F.round("_manual", 6).alias("manual_review_rate"),
        F.round(F.when(F.col("_auto") > 0, F.col("_agree") / F.col("_auto")).otherwise(F.lit(1.0)), 6)
         .alias("auto_historical_agreement"),
        F.round("_tat", 2).alias("avg_processing_hours"),
        F.round("_breach", 6).alias("sla_breach_rate"),
        F.round("_compl", 6).alias("document_completeness"),
        F.round("_value", 2).alias("loan_value"),
        F.round(score, 6).alias("opportunity_score"),
    ).orderBy(F.col("dimension"), F.col("opportunity_score").desc(), F.col("applications").desc(),
              F.col("segment"))


def daily_trend(frame: DataFrame, approve: float = 0.75, reject: float = 0.25,
                day_col: str = "simulation_day") -> DataFrame:
    """Per day; rows without a day are left out (not a 'Missing' group)."""
    w = _with_route(frame, approve, reject).where(F.col(day_col).isNotNull())
    return (w.groupBy(F.col(day_col).alias("date")).agg(
        F.count(F.lit(1)).alias("applications"),
        F.round(rate(F.col("historical_approved")), 6).alias("historical_approval_rate"),
        F.round(rate(F.col("policy_route") == ROUTE_MANUAL), 6).alias("manual_review_rate"),
        F.round(rate(F.col("sla_breached")), 6).alias("sla_breach_rate"),
        F.round(F.avg("processing_hours"), 2).alias("avg_processing_hours"),
        F.round(rate(F.col("channel") == "Digital"), 6).alias("digital_share"))
        .orderBy("date"))


def funnel(frame: DataFrame, approve: float = 0.75, reject: float = 0.25) -> DataFrame:
    """Five stages, one aggregate, unpivoted with ``stack``."""
    w = _with_route(frame, approve, reject)
    manual = F.col("policy_route") == ROUTE_MANUAL
    a = w.agg(F.count(F.lit(1)).alias("n0"),
              F.count_if(F.col("document_completeness") >= 0.90).alias("n1"),
              F.count_if(~manual).alias("n2"), F.count_if(manual).alias("n3"),
              F.count_if(F.col("historical_approved")).alias("n4"))
    parts = ", ".join(f"{i + 1}, '{s}', n{i}" for i, s in enumerate(FUNNEL_STAGES))
    st = a.selectExpr(f"stack(5, {parts}) AS (stage_order, stage, count)", "n0")
    # bar length relative to the largest stage (a 5-row list: bounded window)
    return st.select(F.col("stage_order").cast("int").alias("stage_order"), "stage",
                     F.col("count").cast("long").alias("count"),
                     F.when(F.col("stage_order") == 1, F.lit(1.0))
                      .otherwise(F.round(F.col("count") / F.col("n0"), 6)).alias("rate"),
                     F.round(F.col("count") / F.greatest(F.max("count").over(Window.partitionBy()), F.lit(1)), 6)
                      .alias("relative_to_max"))
