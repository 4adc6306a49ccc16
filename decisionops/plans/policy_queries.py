"""Routing and policy queries: Spark plans and their DuckDB oracle text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import policy as pol
from .analysis_frame import ROUTE_MANUAL, analysis_frame, analysis_frame_sql, route_sql

# Scenarios compared side by side (name, approve, reject,
# analysts, productive hours, volume multiplier).  Whole-number volume
# multipliers keep money totals off half-cent ties, so the rounded values
# do not depend on summation order.
SCENARIOS = [
    ("Baseline", 0.75, 0.25, 1, 6.0, 1.0),
    ("Current", 0.80, 0.20, 2, 6.5, 2.0),
    ("Conservative", 0.90, 0.10, 3, 7.0, 1.0),
    ("Aggressive", 0.60, 0.40, 1, 6.0, 2.0),
]
OPTIMISED_STAFFING = (2, 6.5, 2.0)       # staffing the optimised policy is searched with
STRESS_MULTIPLIERS = [0.75, 1.0, 1.5, 2.0]
INFEASIBLE_GUARDRAIL = 0.999

KPI_NAMES = [
    "applications", "auto_approve", "auto_reject", "manual_review", "auto_decision_rate",
    "manual_review_rate", "auto_historical_agreement", "historical_approval_auto_capture",
    "historical_rejection_auto_capture", "auto_approved_value", "manual_review_value",
    "estimated_review_hours", "manual_everything_hours", "analyst_hours_saved",
    "capacity_utilization", "required_analyst_fte", "max_sustainable_volume_multiplier",
    "daily_manual_cases", "daily_case_capacity", "backlog_growth_cases_per_day", "capacity_status",
]
POLICY_COLS = ["approve_threshold", "reject_threshold", "analysts", "productive_hours_per_day",
               "volume_multiplier"]


# ------------------------------------------------------------------ Spark

def route_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = analysis_frame(spark, sf_dir)
    return f.select(
        "application_id",
        F.round("approval_probability", 6).alias("approval_probability"),
        F.round("uncertainty", 6).alias("uncertainty"),
        F.col("baseline_route").alias("route"),
        "predicted_approved_50", "historical_approved", "historical_match_50")


def policy_kpis_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.policy_metrics(analysis_frame(spark, sf_dir), 0.75, 0.25)


def policy_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.policy_surface(analysis_frame(spark, sf_dir))


def policy_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.optimize_policy(analysis_frame(spark, sf_dir), pol.DEFAULT_GUARDRAIL)


def policy_optimum_infeasible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.optimize_policy(analysis_frame(spark, sf_dir), INFEASIBLE_GUARDRAIL)


def scenario_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All named scenarios plus the optimised policy: the named scenarios,
    the search grid and the fallback are evaluated in one pass over the
    rows (one shared cell table)."""
    frame = analysis_frame(spark, sf_dir)
    offset = 1000
    named_rows = [(i, *s[1:]) for i, s in enumerate(SCENARIOS)]
    grid = [(offset + pid, a, r, n, h, v) for pid, a, r, n, h, v in pol.grid_rows(*OPTIMISED_STAFFING)]
    fallback = [(-1, *pol.FALLBACK_POLICY, *OPTIMISED_STAFFING)]
    allp = pol.evaluate_policies(frame, named_rows + grid + fallback)
    names = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SCENARIOS)],
                                  "policy_id long, scenario string")
    named = (allp.join(F.broadcast(names), "policy_id")
             .select("scenario", *POLICY_COLS, *KPI_NAMES))
    opt = (pol.pick_optimum(allp, pol.DEFAULT_GUARDRAIL, [g[0] for g in grid])
           .select(F.lit("Optimised").alias("scenario"), *POLICY_COLS, *KPI_NAMES))
    return named.unionByName(opt)


def demand_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utilisation of each scenario under demand multipliers."""
    sc = scenario_comparison(spark, sf_dir)
    mult = spark.createDataFrame([(float(m),) for m in STRESS_MULTIPLIERS], "demand_multiplier double")
    base = F.col("capacity_utilization") / F.greatest(F.lit(0.01), F.col("volume_multiplier"))
    util = base * F.col("demand_multiplier")
    return (sc.crossJoin(F.broadcast(mult))
              .select("scenario", "demand_multiplier", F.round(util, 6).alias("utilization"),
                      F.when(util > 1, "Backlog risk").when(util > 0.85, "Tight").otherwise("Healthy")
                      .alias("status")))


# ------------------------------------------------------------------ DuckDB

def _policies_values(rows) -> str:
    vals = ", ".join(f"({int(i)}, {float(a)!r}::DOUBLE, {float(r)!r}::DOUBLE, {int(n)}, {float(h)!r}::DOUBLE,"
                     f" {float(v)!r}::DOUBLE)" for i, a, r, n, h, v in rows)
    return (f"(SELECT * FROM (VALUES {vals}) AS t(policy_id, approve_threshold, reject_threshold, "
            f"analysts, productive_hours_per_day, volume_multiplier))")


def _grid_rows(analysts=1, hours=6.0, volume=1.0):
    return pol.grid_rows(analysts, hours, volume)


def kpi_sql_select() -> str:
    """The KPI projection over a per-policy aggregate (brute-force oracle)."""
    days = "CAST(greatest(1, distinct_days) AS DOUBLE)"
    mm = "coalesce(manual_minutes, 0.0)"
    review = f"({mm} / 60.0 * volume_multiplier)"
    daily_review = f"({review} / {days})"
    cap = "(analysts * productive_hours_per_day)"
    util = f"({daily_review} / {cap})"
    daily_manual = f"(n_manual * volume_multiplier / {days})"
    avg_review = f"(CASE WHEN n_manual > 0 THEN greatest(0.05, {mm} / n_manual / 60.0) ELSE {24.0 / 60!r} END)"
    daily_cap = f"({cap} / {avg_review})"
    every = "(all_minutes / 60.0 * volume_multiplier)"
    auto = "(n_approve + n_reject)"
    return f"""
    CAST(n AS BIGINT) AS applications,
    CAST(n_approve AS BIGINT) AS auto_approve,
    CAST(n_reject AS BIGINT) AS auto_reject,
    CAST(n_manual AS BIGINT) AS manual_review,
    round({auto} / n, 6) AS auto_decision_rate,
    round(n_manual / n, 6) AS manual_review_rate,
    round(CASE WHEN {auto} > 0 THEN (n_approve_hist + n_reject_nohist) / {auto} ELSE 1.0 END, 6) AS auto_historical_agreement,
    round(n_approve_hist / greatest(1, n_hist), 6) AS historical_approval_auto_capture,
    round(n_reject_nohist / greatest(1, n - n_hist), 6) AS historical_rejection_auto_capture,
    round(coalesce(approve_value, 0.0) * volume_multiplier, 2) AS auto_approved_value,
    round(coalesce(manual_value, 0.0) * volume_multiplier, 2) AS manual_review_value,
    round({review}, 2) AS estimated_review_hours,
    round({every}, 2) AS manual_everything_hours,
    round(greatest(0.0, {every} - {review}), 2) AS analyst_hours_saved,
    round({util}, 6) AS capacity_utilization,
    round({daily_review} / productive_hours_per_day, 3) AS required_analyst_fte,
    CASE WHEN {util} > 0 THEN round(volume_multiplier / {util}, 3) ELSE 10.0 END AS max_sustainable_volume_multiplier,
    round({daily_manual}, 2) AS daily_manual_cases,
    round({daily_cap}, 2) AS daily_case_capacity,
    round(greatest(0.0, {daily_manual} - {daily_cap}), 2) AS backlog_growth_cases_per_day,
    CASE WHEN {util} > 1 THEN 'Over capacity' WHEN {util} > 0.85 THEN 'Tight' ELSE 'Healthy' END AS capacity_status"""


def brute_policy_sql(policies_sql: str, name: str = "kpis") -> str:
    """CTEs ``{name}_agg`` and ``{name}``: every row x every policy, grouped."""
    return f"""
{name}_x AS (
  SELECT p.*, a.historical_approved AS hist, a.estimated_review_minutes AS minutes,
         a.loan_value AS value, a.simulation_day AS day,
         {route_sql('a.approval_probability', 'p.approve_threshold', 'p.reject_threshold')} AS rt
  FROM analysis a CROSS JOIN {policies_sql} p
),
{name}_agg AS (
  SELECT policy_id, approve_threshold, reject_threshold, analysts, productive_hours_per_day, volume_multiplier,
    count(*) AS n, count_if(hist) AS n_hist,
    count_if(rt = 'Auto approve') AS n_approve, count_if(rt = 'Auto reject') AS n_reject,
    count_if(rt = '{ROUTE_MANUAL}') AS n_manual,
    count_if(rt = 'Auto approve' AND hist) AS n_approve_hist,
    count_if(rt = 'Auto reject' AND NOT hist) AS n_reject_nohist,
    sum(CASE WHEN rt = '{ROUTE_MANUAL}' THEN minutes END) AS manual_minutes,
    sum(minutes) AS all_minutes,
    sum(CASE WHEN rt = 'Auto approve' THEN value END) AS approve_value,
    sum(CASE WHEN rt = '{ROUTE_MANUAL}' THEN value END) AS manual_value,
    count(DISTINCT day) AS distinct_days
  FROM {name}_x GROUP BY ALL
),
{name} AS (
  SELECT policy_id, approve_threshold, reject_threshold, analysts, productive_hours_per_day, volume_multiplier,
  {kpi_sql_select()}
  FROM {name}_agg
)"""


def optimum_sql(name: str, guardrail: float, analysts=1, hours=6.0, volume=1.0) -> str:
    g = float(min(max(guardrail, pol.GUARDRAIL_RANGE[0]), pol.GUARDRAIL_RANGE[1]))
    rows = _grid_rows(analysts, hours, volume) + [(-1, *pol.FALLBACK_POLICY, analysts, hours, volume)]
    return brute_policy_sql(_policies_values(rows), f"{name}_all") + f""",
{name}_best AS (
  SELECT * FROM {name}_all
  WHERE policy_id >= 0 AND auto_historical_agreement + 1e-12 >= {g!r}
  ORDER BY auto_decision_rate DESC, backlog_growth_cases_per_day ASC, auto_historical_agreement DESC,
           abs((approve_threshold + reject_threshold) / 2 - 0.5) ASC, policy_id ASC
  LIMIT 1
),
{name} AS (
  SELECT true AS feasible, {g!r}::DOUBLE AS minimum_auto_agreement, * EXCLUDE (policy_id) FROM {name}_best
  UNION ALL
  SELECT false AS feasible, {g!r}::DOUBLE AS minimum_auto_agreement, * EXCLUDE (policy_id) FROM {name}_all
  WHERE policy_id = -1 AND NOT EXISTS (SELECT 1 FROM {name}_best)
)"""


def sql_route_applications() -> str:
    return "WITH " + analysis_frame_sql() + """
SELECT application_id, round(approval_probability, 6) AS approval_probability,
       round(uncertainty, 6) AS uncertainty, baseline_route AS route,
       predicted_approved_50, historical_approved, historical_match_50
FROM analysis"""


def sql_policy_kpis_baseline() -> str:
    return ("WITH " + analysis_frame_sql() + "," + brute_policy_sql(_policies_values([(0, 0.75, 0.25, 1, 6.0, 1.0)]))
            + "\nSELECT * EXCLUDE (policy_id) FROM kpis")


def sql_policy_surface() -> str:
    return "WITH " + analysis_frame_sql() + "," + brute_policy_sql(_policies_values(_grid_rows())) + \
        "\nSELECT * FROM kpis"


def sql_policy_optimum() -> str:
    return "WITH " + analysis_frame_sql() + "," + optimum_sql("opt", pol.DEFAULT_GUARDRAIL) + \
        "\nSELECT * FROM opt"


def sql_policy_optimum_infeasible() -> str:
    return "WITH " + analysis_frame_sql() + "," + optimum_sql("opt", INFEASIBLE_GUARDRAIL) + \
        "\nSELECT * FROM opt"


def _scenario_cte() -> str:
    names = ", ".join(f"({i}, '{s[0]}')" for i, s in enumerate(SCENARIOS))
    cols = ", ".join(POLICY_COLS + KPI_NAMES)
    return ("," + brute_policy_sql(_policies_values([(i, *s[1:]) for i, s in enumerate(SCENARIOS)]), "named")
            + "," + optimum_sql("opt", pol.DEFAULT_GUARDRAIL, *OPTIMISED_STAFFING) + f""",
scen_names AS (SELECT * FROM (VALUES {names}) AS t(policy_id, scenario)),
scenarios AS (
  SELECT s.scenario, {cols} FROM named k JOIN scen_names s USING (policy_id)
  UNION ALL
  SELECT 'Optimised' AS scenario, {cols} FROM opt
)""")


def sql_scenario_comparison() -> str:
    return "WITH " + analysis_frame_sql() + _scenario_cte() + "\nSELECT * FROM scenarios"


def sql_demand_stress() -> str:
    mult = ", ".join(f"({m!r}::DOUBLE)" for m in STRESS_MULTIPLIERS)
    util = "(capacity_utilization / greatest(0.01, volume_multiplier) * demand_multiplier)"
    return "WITH " + analysis_frame_sql() + _scenario_cte() + f""",
mult AS (SELECT * FROM (VALUES {mult}) AS t(demand_multiplier))
SELECT scenario, demand_multiplier, round({util}, 6) AS utilization,
       CASE WHEN {util} > 1 THEN 'Backlog risk' WHEN {util} > 0.85 THEN 'Tight' ELSE 'Healthy' END AS status
FROM scenarios CROSS JOIN mult"""


QUERIES = {
    "route_applications": (route_applications, sql_route_applications),
    "policy_kpis_baseline": (policy_kpis_baseline, sql_policy_kpis_baseline),
    "policy_surface": (policy_surface, sql_policy_surface),
    "policy_optimum": (policy_optimum, sql_policy_optimum),
    "policy_optimum_infeasible": (policy_optimum_infeasible, sql_policy_optimum_infeasible),
    "scenario_comparison": (scenario_comparison, sql_scenario_comparison),
    "demand_stress": (demand_stress, sql_demand_stress),
}


def validate_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenario rules over the compared scenarios (the optimised one comes
    from the data) plus one deliberately inverted copy of each, so both
    outcomes are exercised."""
    from ..operators.validate import scenario_violations
    sc = scenario_comparison(spark, sf_dir).select(
        "scenario", "approve_threshold", "reject_threshold", "analysts",
        F.col("productive_hours_per_day").alias("productive_hours"), "volume_multiplier",
        F.lit("channel").alias("segment_dimension"))
    inverted = sc.select(F.concat(F.col("scenario"), F.lit(" (inverted)")).alias("scenario"),
                         F.col("reject_threshold").alias("approve_threshold"),
                         F.col("approve_threshold").alias("reject_threshold"), "analysts", "productive_hours",
                         "volume_multiplier", F.lit("gender").alias("segment_dimension"))
    return scenario_violations(sc.unionByName(inverted)).select("scenario", "violations", "valid")


def sql_validate_scenarios() -> str:
    checks = [("approve_threshold", "a > 0.5 AND a < 1.0"), ("reject_threshold", "r > 0.0 AND r < 0.5"),
              ("threshold_order", "r < a"), ("analysts", "analysts >= 1 AND analysts <= 500"),
              ("productive_hours", "h > 0.5 AND h <= 12.0"), ("volume_multiplier", "v > 0.1 AND v <= 10.0"),
              ("segment_dimension", "d IN ('channel', 'property_area', 'education', 'self_employed', "
                                    "'credit_history')")]
    fails = ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in checks)
    ok = " AND ".join(f"coalesce({c}, false)" for _, c in checks)
    return "WITH " + analysis_frame_sql() + _scenario_cte() + f""",
sv AS (
  SELECT scenario, approve_threshold AS a, reject_threshold AS r, analysts, productive_hours_per_day AS h,
         volume_multiplier AS v, 'channel' AS d FROM scenarios
  UNION ALL
  SELECT scenario || ' (inverted)', reject_threshold, approve_threshold, analysts, productive_hours_per_day,
         volume_multiplier, 'gender' FROM scenarios
)
SELECT scenario, concat_ws(',', {fails}) AS violations, {ok} AS valid FROM sv"""


QUERIES["validate_scenarios"] = (validate_scenarios, sql_validate_scenarios)
