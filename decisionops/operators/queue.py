"""Review queue, priority fields and case records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, safe_number
from ..plans.analysis_frame import manual_predicate
from .globalrank import percent_rank_avg

QUEUE_DEFAULT_LIMIT = 40
HIGH_PRIORITY = 70.0
MEDIUM_PRIORITY = 50.0


def outcome_label(c: str = "historical_approved"):
    return F.when(F.col(c), F.lit("Approved")).otherwise(F.lit("Rejected"))


def queue_candidates(frame: DataFrame, approve: float = 0.75, reject: float = 0.25) -> DataFrame:
    """Manual rows with the policy priority.  The value percentile is taken
    over manual rows only, ties averaged (distributed, no global window)."""
    manual = frame.where(manual_predicate("approval_probability", approve, reject))
    ranked = percent_rank_avg(manual, "loan_value", "value_pct")
    pp = clip(F.col("priority_score") + F.col("value_pct") * 8.0
              + clip(F.col("processing_hours") / 24.0, 0.0, 2.0) * 6.0, 0.0, 100.0)
    return ranked.withColumn("policy_priority", pp)


def review_queue(frame: DataFrame, approve: float = 0.75, reject: float = 0.25,
                 limit: int = QUEUE_DEFAULT_LIMIT) -> DataFrame:
    """Top-k manual cases (TakeOrderedAndProject: a per-partition top-k, then
    a merge of k rows per partition -- never a full sort)."""
    return queue_columns(_top(queue_candidates(frame, approve, reject), limit))


def _top(candidates: DataFrame, limit: int) -> DataFrame:
    if int(limit) < 1:
        raise ValueError("a queue needs a limit of at least 1")
    return (candidates.orderBy(F.col("policy_priority").desc(), F.col("processing_hours").desc(),
                               F.col("loan_value").desc(), F.col("application_id").asc()).limit(int(limit)))


def queue_columns(candidates: DataFrame, *more: str) -> DataFrame:
    return candidates.select(
        *more,
        "application_id",
        F.round("policy_priority", 1).alias("priority"),
        "priority_reason",
        F.round("approval_probability", 6).alias("approval_probability"),
        F.round("loan_value", 2).alias("loan_value"),
        "channel", "property_area",
        F.round("document_completeness", 6).alias("document_completeness"),
        F.round("processing_hours", 2).alias("processing_hours"),
        "sla_breached", "analyst",
        outcome_label().alias("historical_outcome"))


def priority_band(c="priority"):
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= HIGH_PRIORITY, "high").when(c >= MEDIUM_PRIORITY, "medium").otherwise("low")


# Preset filters of a queue; a missing value never passes.
PRESETS = {
    "all": None,
    "high_priority": lambda: F.round("policy_priority", 1) >= HIGH_PRIORITY,
    "sla_breached": lambda: F.col("sla_breached"),
    "document_friction": lambda: F.col("priority_reason") == "Document friction",
}


def matches(search: str):
    """Case-insensitive search over the text fields of a case."""
    text = F.lower(F.concat_ws(" ", F.col("application_id").cast("string"), "channel",
                               "priority_reason", "property_area", "analyst"))
    return text.contains(search.lower())


def preset_queues(frame: DataFrame, presets=tuple(PRESETS), search: str = "", approve: float = 0.75,
                  reject: float = 0.25, limit: int = QUEUE_DEFAULT_LIMIT) -> DataFrame:
    """Top-k of the manual cases that pass a search, under each preset.  All manual cases are
    ranked once, then filtered, so a match is found whatever its rank; a case goes to every
    preset that it passes, and tasks keep at most k cases a preset before the last ranking."""
    if int(limit) < 1:
        raise ValueError("a queue needs a limit of at least 1")
    found = queue_candidates(frame, approve, reject).where(matches(search))
    passed = F.array_compact(F.array(*[
        F.lit(p) if PRESETS[p] is None else F.when(PRESETS[p](), F.lit(p)) for p in presets]))
    order = (F.col("policy_priority").desc(), F.col("processing_hours").desc(), F.col("loan_value").desc(),
             F.col("application_id").asc())
    dealt = found.withColumn("preset", F.explode(passed))
    top = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("preset").orderBy(*order)))
    return (queue_columns(top.where(F.col("_rank") <= int(limit)), "preset")
            .withColumn("priority_band", priority_band("priority")))


def filtered_queue(frame: DataFrame, preset: str = "all", search: str = "", approve: float = 0.75,
                   reject: float = 0.25, limit: int = QUEUE_DEFAULT_LIMIT) -> DataFrame:
    """Top-k of the manual cases that pass a preset and a search."""
    return preset_queues(frame, (preset,), search, approve, reject, limit).drop("preset")


def case_records(frame: DataFrame, requests: DataFrame, id_col: str = "application_id") -> DataFrame:
    """Bulk case lookup: every requested id once, with ``found`` false for
    unknown ids (left join; ``left_anti`` gives the not-found list)."""
    req = requests.select(F.col(id_col)).distinct()
    f = frame.select(
        id_col,
        outcome_label().alias("historical_outcome"),
        F.round("approval_probability", 6).alias("approval_probability"),
        "baseline_route",
        F.round("priority_score", 1).alias("priority_score"),
        "priority_reason", "channel", "analyst",
        F.round("processing_hours", 2).alias("processing_hours"),
        F.round("sla_hours", 2).alias("sla_hours"),
        "sla_breached",
        F.round("document_completeness", 6).alias("document_completeness"),
        F.round("loan_value", 2).alias("loan_value"),
        F.col("married").alias("applicant_married"),
        F.col("dependents").alias("applicant_dependents"),
        F.col("education").alias("applicant_education"),
        F.col("self_employed").alias("applicant_self_employed"),
        safe_number(F.col("applicant_income")).alias("applicant_income"),
        safe_number(F.col("coapplicant_income")).alias("applicant_coapplicant_income"),
        safe_number(F.col("loan_amount")).alias("applicant_loan_amount_thousands"),
        safe_number(F.col("loan_amount_term")).alias("applicant_loan_amount_term_months"),
        F.col("credit_history").cast("int").alias("applicant_credit_history"),
        F.col("property_area").alias("applicant_property_area"),
        F.lit(True).alias("found"))
    out = req.join(f, id_col, "left")
    return out.withColumn("found", F.coalesce(F.col("found"), F.lit(False)))


def case_record_nested(flat: DataFrame, model: str, version: str) -> DataFrame:
    """The nested form: ``applicant`` and ``audit`` structs; the audit names
    the model and its version."""
    app_cols = [c for c in flat.columns if c.startswith("applicant_")]
    rest = [c for c in flat.columns if c not in app_cols]
    return flat.select(
        *rest,
        F.struct(*[F.col(c).alias(c[len("applicant_"):]) for c in app_cols]).alias("applicant"),
        F.struct(F.lit(model).alias("model"), F.lit(version).alias("model_version"),
                 F.lit("historical loan approval").alias("source_target"),
                 F.array(*[F.lit(x) for x in ("channel", "created_at", "analyst", "processing_hours",
                                              "sla_hours")]).alias("simulation_fields")).alias("audit"))
