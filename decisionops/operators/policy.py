"""Policy KPIs, capacity model, policy surface and constrained optimum.

One pass for any number of policies
-----------------------------------
Routing depends on the score only through its order against the
thresholds.  With the sorted distinct approve thresholds ``A`` and reject
thresholds ``R`` each row gets two bin ids

    a = #{t in A : t <= p}        r = #{t in R : t < p}   (r = |R| if p is null)

and policy (A[i], R[j]) auto-approves iff ``a > i``, auto-rejects iff not
approved and ``r <= j`` (both bounds inclusive), else routes to review.  So
the frame is aggregated once to (a, r, day) cells -- at most
``(|A|+1)(|R|+1)`` cells per day -- and every policy / scenario is evaluated
on that small table by a broadcast cross join.  One scan replaces one scan
per policy.  The policy table is a parameter table; its size is checked
before it is broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.analysis_frame import (DEFAULT_ANALYSTS, DEFAULT_PRODUCTIVE_HOURS,
                                    DEFAULT_REVIEW_MINUTES)
from ..session import materialize

MAX_POLICIES = 10_000    # parameter-table bound for broadcasting

# The policy search grid and its fallback.
GRID_APPROVE = [round(0.55 + i * 0.025, 3) for i in range(17)]
GRID_REJECT = [round(0.05 + j * 0.025, 3) for j in range(17)]
FALLBACK_POLICY = (0.90, 0.10)
DEFAULT_GUARDRAIL = 0.90
GUARDRAIL_RANGE = (0.5, 0.999)

POLICY_SCHEMA = ("policy_id long, approve_threshold double, reject_threshold double, "
                 "analysts int, productive_hours_per_day double, volume_multiplier double")


def check_policy(approve: float, reject: float, analysts: int = DEFAULT_ANALYSTS,
                 productive_hours: float = DEFAULT_PRODUCTIVE_HOURS, volume_multiplier: float = 1.0):
    if not 0 < reject < approve < 1:
        raise ValueError("Thresholds must satisfy 0 < reject < approve < 1")
    if analysts < 1 or productive_hours <= 0 or volume_multiplier <= 0:
        raise ValueError("Capacity inputs must be positive")


def policies_frame(spark: SparkSession, rows) -> DataFrame:
    """rows: iterable of (policy_id, approve, reject, analysts, hours, volume)."""
    rows = [(int(i), float(a), float(r), int(n), float(h), float(v)) for i, a, r, n, h, v in rows]
    for _, a, r, n, h, v in rows:
        check_policy(a, r, n, h, v)
    return spark.createDataFrame(rows, POLICY_SCHEMA)


def grid_rows(analysts=DEFAULT_ANALYSTS, productive_hours=DEFAULT_PRODUCTIVE_HOURS,
              volume_multiplier=1.0) -> list:
    rows, pid = [], 0
    for a in GRID_APPROVE:
        for r in GRID_REJECT:
            if r < a:
                rows.append((pid, a, r, analysts, productive_hours, volume_multiplier))
                pid += 1
    return rows


def _check_rows(rows):
    rows = [(int(i), float(a), float(r), int(n), float(h), float(v)) for i, a, r, n, h, v in rows]
    if len(rows) > MAX_POLICIES:
        raise ValueError(f"policy table has {len(rows)} rows; limit is {MAX_POLICIES}")
    return rows


def _rank_among(p: Column, ts: list, inclusive: bool, lo: int = 0, hi: int | None = None) -> Column:
    """How many of the sorted thresholds lie below ``p`` (or at it, if
    inclusive): a balanced tree of comparisons, as deep as log2 of their number."""
    hi = len(ts) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    t = F.lit(float(ts[mid]))
    return F.when(p >= t if inclusive else p > t, _rank_among(p, ts, inclusive, mid + 1, hi)).otherwise(
        _rank_among(p, ts, inclusive, lo, mid))


def bin_ids(p: Column, approve_ts, reject_ts) -> tuple[Column, Column]:
    """Bin ids of a score; thresholds are compared as given (a reference that
    builds its grid by repeated addition may lie one unit in the last place higher)."""
    a = F.when(p.isNull(), F.lit(0)).otherwise(_rank_among(p, sorted(approve_ts), True))
    r = F.when(p.isNull(), F.lit(len(reject_ts))).otherwise(_rank_among(p, sorted(reject_ts), False))
    return a, r


def route_cells(frame: DataFrame, approve_ts, reject_ts, score_col="approval_probability",
                label_col="historical_approved", minutes_col="estimated_review_minutes",
                value_col="loan_value", day_col="simulation_day") -> DataFrame:
    """(a, r, day) cells with counts and sums -- the only pass over the rows."""
    a, r = bin_ids(F.col(score_col), approve_ts, reject_ts)
    hist = F.coalesce(F.col(label_col), F.lit(False))
    return (frame.select(a.alias("a"), r.alias("r"), F.col(day_col).alias("day"),
                         hist.alias("hist"), F.col(minutes_col).alias("minutes"),
                         F.col(value_col).alias("value"))
            .groupBy("a", "r", "day")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hist")).alias("n_hist"),
                 F.sum("minutes").alias("minutes"), F.sum("value").alias("value")))


def evaluate_policies(frame: DataFrame, rows, **cols) -> DataFrame:
    """KPI row per policy (see ``kpi_columns``).  ``rows`` is the policy
    parameter table as (policy_id, approve, reject, analysts, hours, volume)
    tuples; it is size-checked, then broadcast."""
    rows = _check_rows(rows)
    policies = policies_frame(frame.sparkSession, rows)
    approve_ts = sorted({r[1] for r in rows})
    reject_ts = sorted({r[2] for r in rows})
    # cells and days both come from the stored cell table: one scan of the rows
    cells_day = materialize(route_cells(frame, approve_ts, reject_ts, **cols), "policy_cells", (uuid.uuid4().hex,))
    days = cells_day.agg(F.count_distinct("day").alias("distinct_days"))
    cells = cells_day.groupBy("a", "r").agg(
        F.sum("n").alias("n"), F.sum("n_hist").alias("n_hist"),
        F.sum("minutes").alias("minutes"), F.sum("value").alias("value"))
    ai = F.array_position(F.array(*[F.lit(float(t)) for t in approve_ts]),
                          F.col("approve_threshold")) - 1
    rj = F.array_position(F.array(*[F.lit(float(t)) for t in reject_ts]),
                          F.col("reject_threshold")) - 1
    pol = policies.select("*", ai.alias("_ai"), rj.alias("_rj"))
    x = cells.crossJoin(F.broadcast(pol))
    appr = F.col("a") > F.col("_ai")
    rej = ~appr & (F.col("r") <= F.col("_rj"))
    man = ~appr & ~rej
    s = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))
    agg = x.groupBy(*policies.columns).agg(
        F.sum("n").alias("n"), F.sum("n_hist").alias("n_hist"),
        s(appr, "n").alias("n_approve"), s(rej, "n").alias("n_reject"), s(man, "n").alias("n_manual"),
        s(appr, "n_hist").alias("n_approve_hist"),
        (s(rej, "n") - s(rej, "n_hist")).alias("n_reject_nohist"),
        F.sum(F.when(man, F.col("minutes"))).alias("manual_minutes"),
        F.sum("minutes").alias("all_minutes"),
        F.sum(F.when(appr, F.col("value"))).alias("approve_value"),
        F.sum(F.when(man, F.col("value"))).alias("manual_value"),
    )
    return agg.crossJoin(F.broadcast(days)).select(*policies.columns, *kpi_columns())


def kpi_columns() -> list[Column]:
    """Capacity / automation KPIs from the aggregated counts (scalar math)."""
    c = F.col
    vol, n = c("volume_multiplier"), c("n")
    auto = c("n_approve") + c("n_reject")
    days = F.greatest(F.lit(1), c("distinct_days")).cast("double")
    manual_minutes = F.coalesce(c("manual_minutes"), F.lit(0.0))
    review_hours = manual_minutes / 60.0 * vol
    daily_review = review_hours / days
    capacity = c("analysts") * c("productive_hours_per_day")
    util = daily_review / capacity
    daily_manual = c("n_manual") * vol / days
    avg_review = F.when(c("n_manual") > 0, F.greatest(F.lit(0.05), manual_minutes / c("n_manual") / 60.0)) \
                  .otherwise(F.lit(DEFAULT_REVIEW_MINUTES / 60))
    daily_capacity = capacity / avg_review
    backlog = F.greatest(F.lit(0.0), daily_manual - daily_capacity)
    everything = c("all_minutes") / 60.0 * vol
    saved = F.greatest(F.lit(0.0), everything - review_hours)
    agreement = F.when(auto > 0, (c("n_approve_hist") + c("n_reject_nohist")) / auto).otherwise(F.lit(1.0))
    return [
        F.col("n").cast("long").alias("applications"),
        c("n_approve").cast("long").alias("auto_approve"),
        c("n_reject").cast("long").alias("auto_reject"),
        c("n_manual").cast("long").alias("manual_review"),
        F.round(auto / n, 6).alias("auto_decision_rate"),
        F.round(c("n_manual") / n, 6).alias("manual_review_rate"),
        F.round(agreement, 6).alias("auto_historical_agreement"),
        F.round(c("n_approve_hist") / F.greatest(F.lit(1), c("n_hist")), 6)
         .alias("historical_approval_auto_capture"),
        F.round(c("n_reject_nohist") / F.greatest(F.lit(1), n - c("n_hist")), 6)
         .alias("historical_rejection_auto_capture"),
        F.round(F.coalesce(c("approve_value"), F.lit(0.0)) * vol, 2).alias("auto_approved_value"),
        F.round(F.coalesce(c("manual_value"), F.lit(0.0)) * vol, 2).alias("manual_review_value"),
        F.round(review_hours, 2).alias("estimated_review_hours"),
        F.round(everything, 2).alias("manual_everything_hours"),
        F.round(saved, 2).alias("analyst_hours_saved"),
        F.round(util, 6).alias("capacity_utilization"),
        F.round(daily_review / c("productive_hours_per_day"), 3).alias("required_analyst_fte"),
        F.when(util > 0, F.round(vol / util, 3)).otherwise(F.lit(10.0)).alias("max_sustainable_volume_multiplier"),
        F.round(daily_manual, 2).alias("daily_manual_cases"),
        F.round(daily_capacity, 2).alias("daily_case_capacity"),
        F.round(backlog, 2).alias("backlog_growth_cases_per_day"),
        F.when(util > 1, "Over capacity").when(util > 0.85, "Tight").otherwise("Healthy").alias("capacity_status"),
    ]


def policy_metrics(frame: DataFrame, approve: float = 0.75, reject: float = 0.25,
                   analysts: int = DEFAULT_ANALYSTS, productive_hours: float = DEFAULT_PRODUCTIVE_HOURS,
                   volume_multiplier: float = 1.0) -> DataFrame:
    rows = [(0, approve, reject, analysts, productive_hours, volume_multiplier)]
    return evaluate_policies(frame, rows).drop("policy_id")


def policy_surface(frame: DataFrame, analysts=DEFAULT_ANALYSTS, productive_hours=DEFAULT_PRODUCTIVE_HOURS,
                   volume_multiplier=1.0) -> DataFrame:
    return evaluate_policies(frame, grid_rows(analysts, productive_hours, volume_multiplier))


def optimize_policy(frame: DataFrame, minimum_auto_agreement: float = DEFAULT_GUARDRAIL,
                    analysts=DEFAULT_ANALYSTS, productive_hours=DEFAULT_PRODUCTIVE_HOURS,
                    volume_multiplier=1.0) -> DataFrame:
    """Best feasible grid policy: maximise (auto rate, -backlog, agreement,
    -|mid - 0.5|), earliest grid point on ties; fallback 0.90/0.10 flagged
    ``feasible = false`` when no policy meets the guardrail.  The guardrail
    is compared with the rounded agreement (tolerance 1e-12)."""
    rows = grid_rows(analysts, productive_hours, volume_multiplier)
    rows.append((-1, *FALLBACK_POLICY, analysts, productive_hours, volume_multiplier))
    return pick_optimum(evaluate_policies(frame, rows), minimum_auto_agreement)


def pick_optimum(allp: DataFrame, minimum_auto_agreement: float = DEFAULT_GUARDRAIL,
                 grid_ids=None) -> DataFrame:
    """The optimum from a KPI table holding the grid (policy_id >= 0, or the
    ids in ``grid_ids``) and the fallback (policy_id = -1)."""
    g = float(min(max(minimum_auto_agreement, GUARDRAIL_RANGE[0]), GUARDRAIL_RANGE[1]))
    in_grid = (F.col("policy_id") >= 0) if grid_ids is None else F.col("policy_id").isin(*grid_ids)
    feasible = allp.where(in_grid & (F.col("auto_historical_agreement") + F.lit(1e-12) >= F.lit(g)))
    key = F.struct(F.col("auto_decision_rate"), -F.col("backlog_growth_cases_per_day"),
                   F.col("auto_historical_agreement"),
                   -F.abs((F.col("approve_threshold") + F.col("reject_threshold")) / 2 - 0.5),
                   -F.col("policy_id"))
    best = (feasible.agg(F.max_by(F.struct(*allp.columns), key).alias("b"))
            .where(F.col("b").isNotNull()).select("b.*"))
    fallback = allp.where(F.col("policy_id") == -1)
    # exactly one of the two rows survives: best if it exists, else fallback
    has_best = best.agg(F.count(F.lit(1)).alias("_nb"))
    cand = (best.withColumn("feasible", F.lit(True))
            .unionByName(fallback.withColumn("feasible", F.lit(False)))
            .crossJoin(F.broadcast(has_best))
            .where(F.col("feasible") | (F.col("_nb") == 0)).drop("_nb"))
    return cand.select(F.col("feasible"), F.lit(g).alias("minimum_auto_agreement"),
                       *[c for c in allp.columns if c != "policy_id"])
