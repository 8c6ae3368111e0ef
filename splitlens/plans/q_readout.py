"""Registered queries: bucketing, assignment and the experiment read-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitlens.functions.hashing import bucket_col
from splitlens.functions.normal import two_sided_p_sql, z_quantile
from splitlens.operators import assignment, metrics, stats
from splitlens.plans import oracle_forms as forms
from splitlens.plans.catalog import register

# ---------------------------------------------------------------- SQL helpers

def ct_sql(src: str, cols: list[str]) -> str:
    """The first variant of each run beside every other one."""
    sides = ", ".join(f"c.{x} AS c_{x}, t.{x} AS t_{x}" for x in cols)
    return (f"SELECT run_id, c.variant AS control_variant, t.variant AS test_variant, {sides} "
            f"FROM (SELECT * FROM ({src}) s QUALIFY variant = min(variant) OVER (PARTITION BY run_id)) c "
            f"JOIN ({src}) t USING (run_id) WHERE t.variant > c.variant")


def ratio_sql(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN cast({num} AS double) / {den} ELSE cast(0.0 AS double) END"


def lift_sql(t: str, c: str) -> str:
    return f"CASE WHEN {c} > 0 THEN ({t} - {c}) / {c} ELSE cast(0.0 AS double) END"


A, E = "fx_assignments", "fx_events"
AB_PRIMARY_SQL = forms.converters(A, E, "hit")
GUARD_COUNTS_SQL = forms.guardrails(A, E)
WEIGHTED_SQL = forms.weighted(A, E)

# ---------------------------------------------------------------- bucketing


@register("variant_bucket", """
SELECT user_id, bucket, CASE WHEN bucket >= 50 THEN 'B' ELSE 'A' END AS variant FROM fx_bucket""")
def q_variant_bucket(fx):
    return assignment.bucket_users(fx.events.select("user_id"))


@register("assign_variant", """
SELECT b.user_id, b.bucket,
       CASE WHEN b.bucket >= 50 THEN 'B' ELSE 'A' END AS variant_active,
       CASE WHEN s.winner IS NOT NULL AND s.winner <> '' THEN s.winner
            WHEN b.bucket >= 50 THEN 'B' ELSE 'A' END AS variant
FROM fx_bucket b
LEFT JOIN (SELECT json_extract_string(variant_config, '$.winning_variant') AS winner
           FROM fx_adoptions ORDER BY adopted_at DESC, experiment_id DESC LIMIT 1) s ON true""")
def q_assign_variant(fx):
    bucketed = assignment.bucket_users(fx.events.select("user_id"))
    state = assignment.assignment_state(active=False, adoptions=fx.adoptions)
    return assignment.apply_state(bucketed.withColumn("variant_active", F.col("variant")), state)


@register("assign_once", """
SELECT i.* FROM (
  SELECT user_id, run_id, min(assigned_at) AS assigned_at,
         arg_min(experiment_id, assigned_at) AS experiment_id, arg_min(variant, assigned_at) AS variant,
         arg_min(weight, assigned_at) AS weight
  FROM fx_assignments GROUP BY user_id, run_id) i
WHERE NOT EXISTS (SELECT 1 FROM fx_assignments x
                  WHERE x.run_id < 'run_20240115'
                    AND x.user_id = i.user_id AND x.run_id IS NOT DISTINCT FROM i.run_id)""")
def q_assign_once(fx):
    existing = fx.assignments.filter(F.col("run_id") < "run_20240115")
    return assignment.assign_once(fx.assignments, existing)


HARD_STORED_UNTIL = "2024-01-15"


@register("assign_once_null_runs", f"""
SELECT user_id, run_id, min(assigned_at) AS assigned_at, 'exp_default' AS experiment_id,
       first(variant ORDER BY assigned_at, variant, weight) AS variant, first(weight ORDER BY assigned_at, variant, weight) AS weight
FROM fx_hard_assignments GROUP BY user_id, run_id
HAVING min(assigned_at) >= TIMESTAMP '{HARD_STORED_UNTIL}'""")
def q_assign_once_null_runs(fx):
    a = fx.hard_assignments
    return assignment.assign_once(a, a.filter(F.col("assigned_at") < F.lit(HARD_STORED_UNTIL).cast("timestamp_ntz")))


# ---------------------------------------------------------------- read-out


@register("ab_primary", AB_PRIMARY_SQL)
def q_ab_primary(fx):
    return metrics.ab_primary(fx.assignments, fx.events, "CTR")


AB_STATS_SQL = f"""
WITH ct AS ({ct_sql(AB_PRIMARY_SQL, ['users', 'conversions'])}),
r AS (SELECT run_id, control_variant, test_variant, c_users AS control_users, c_conversions AS control_conversions,
             t_users AS test_users, t_conversions AS test_conversions,
             {ratio_sql('c_conversions', 'c_users')} AS control_rate,
             {ratio_sql('t_conversions', 't_users')} AS test_rate,
             cast(c_conversions + t_conversions AS double) / nullif(c_users + t_users, 0) AS pp
      FROM ct),
s AS (SELECT *, {lift_sql('test_rate', 'control_rate')} AS lift,
             CASE WHEN control_users > 0 AND test_users > 0
                  THEN sqrt(pp * (1 - pp) * (1.0 / control_users + 1.0 / test_users))
                  ELSE cast(0.0 AS double) END AS se
      FROM r),
z AS (SELECT *, CASE WHEN se > 0 THEN (test_rate - control_rate) / se ELSE cast(0.0 AS double) END AS z_score FROM s),
p AS (SELECT *, CASE WHEN se > 0 THEN {two_sided_p_sql('z_score')} ELSE cast(1.0 AS double) END AS p_value FROM z)
SELECT run_id, control_variant, test_variant, control_users, control_conversions, test_users, test_conversions,
       control_rate, test_rate, lift, se, z_score, p_value,
       CASE WHEN p_value < 0.05 AND lift > 0 THEN '{stats.DECISION_WINNER}'
            WHEN p_value < 0.05 THEN '{stats.DECISION_LOSER}' ELSE '{stats.DECISION_NONE}' END AS decision,
       CASE WHEN p_value < 0.05 AND lift > 0 THEN '{stats.ADVICE_ADOPT}'
            WHEN p_value < 0.05 AND lift < 0 THEN '{stats.ADVICE_RERUN}' ELSE '{stats.ADVICE_NONE}' END AS advice
FROM p"""


@register("ab_stats", AB_STATS_SQL, doubles=("control_rate", "test_rate", "lift", "se", "z_score", "p_value"))
def q_ab_stats(fx):
    return stats.ab_stats(metrics.ab_primary(fx.assignments, fx.events, "CTR"))


# Three arms: each other arm is compared with the control.
ARMS_SQL = """(SELECT a.* REPLACE (CASE WHEN b.bucket >= 75 THEN 'C' ELSE a.variant END AS variant)
  FROM fx_assignments a JOIN fx_bucket b ON b.user_id = a.user_id)"""


@register("ab_stats_arms", AB_STATS_SQL.replace(AB_PRIMARY_SQL, forms.converters(ARMS_SQL, E, "hit")),
          doubles=("control_rate", "test_rate", "lift", "se", "z_score", "p_value"))
def q_ab_stats_arms(fx):
    third = F.when(bucket_col(F.col("user_id")) >= 75, F.lit("C")).otherwise(F.col("variant"))
    return stats.ab_stats(metrics.ab_primary(fx.assignments.withColumn("variant", third), fx.events, "CTR"))


@register("variant_ci", f"""
SELECT run_id, variant, users, conversions,
       ({ratio_sql('conversions', 'users')}) * 100 AS rate_pct,
       CASE WHEN users > 0 THEN 1.96 * sqrt(({ratio_sql('conversions', 'users')}) * (1 - ({ratio_sql('conversions', 'users')})) / users)
            ELSE cast(0.0 AS double) END * 100 AS error_pct
FROM ({AB_PRIMARY_SQL}) c""", doubles=("rate_pct", "error_pct"))
def q_variant_ci(fx):
    return stats.variant_ci(metrics.ab_primary(fx.assignments, fx.events, "CTR"))


@register("guardrail_counts", GUARD_COUNTS_SQL, doubles=("revenue",))
def q_guardrail_counts(fx):
    return metrics.guardrail_counts(fx.assignments, fx.events)


GUARD_VERDICTS_SQL = f"""
WITH ct AS ({ct_sql(GUARD_COUNTS_SQL, ['users', 'conversions', 'revenue', 'clicks', 'bounces'])}),
m AS (
  SELECT run_id, test_variant, 'CVR' AS metric, {ratio_sql('c_conversions', 'c_users')} AS control, {ratio_sql('t_conversions', 't_users')} AS test FROM ct
  UNION ALL
  SELECT run_id, test_variant, 'AOV', {ratio_sql('c_revenue', 'c_conversions')}, {ratio_sql('t_revenue', 't_conversions')} FROM ct
  UNION ALL
  SELECT run_id, test_variant, 'Bounce Rate', {ratio_sql('c_bounces', 'c_users')}, {ratio_sql('t_bounces', 't_users')} FROM ct
  UNION ALL
  SELECT run_id, test_variant, 'CTR', {ratio_sql('c_clicks', 'c_users')}, {ratio_sql('t_clicks', 't_users')} FROM ct),
l AS (SELECT *, {lift_sql('test', 'control')} AS lift FROM m)
SELECT run_id, test_variant, metric, control, test, lift,
       CASE WHEN metric = 'Bounce Rate' THEN lift <= 0.05 ELSE lift >= -0.05 END AS passed
FROM l"""


@register("guardrail_verdicts", GUARD_VERDICTS_SQL, doubles=("control", "test", "lift"))
def q_guardrail_verdicts(fx):
    return stats.guardrail_verdicts(metrics.guardrail_counts(fx.assignments, fx.events), margin_pct=5.0)


@register("weighted_metrics", WEIGHTED_SQL)
def q_weighted_metrics(fx):
    return metrics.weighted_metrics(fx.assignments, fx.events)


def _delta_sql() -> str:
    cols = list(stats.METRIC_COLUMNS)
    parts = []
    for c in cols:
        a, b = f"cast(c_{c} AS double)", f"cast(t_{c} AS double)"
        pct = f"(({b} - {a}) / {a} * 100)"
        parts.append(
            f"SELECT run_id, test_variant, '{c}' AS metric, {a} AS control, {b} AS test, "
            f"CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = 0 THEN 'N/A' "
            f"ELSE concat(CASE WHEN {pct} >= 0 THEN '+' ELSE '' END, printf('%.1f%%', {pct})) END AS delta FROM ct")
    return f"WITH ct AS ({ct_sql(WEIGHTED_SQL, cols)})\n" + "\nUNION ALL\n".join(parts)


@register("metrics_delta", _delta_sql(), doubles=("control", "test"))
def q_metrics_delta(fx):
    return stats.metrics_delta(metrics.weighted_metrics(fx.assignments, fx.events))


# ---------------------------------------------------------------- planning

BASELINE_SQL = forms.baseline(A, E)


@register("baseline_rate", BASELINE_SQL, doubles=("ctr_baseline", "cvr_baseline"))
def q_baseline_rate(fx):
    return assignment.baseline_rates(fx.assignments, fx.events, by=("run_id",))


# The dashboard's baseline: history users, who are outside runs.
@register("baseline_rate_history", forms.baseline("fx_hard_assignments", "fx_hard_events", "starts_with(user_id, 'user_hist_')"),
          doubles=("ctr_baseline", "cvr_baseline"))
def q_baseline_rate_history(fx):
    return assignment.baseline_rates(fx.hard_assignments, fx.hard_events, by=("run_id",), user_like="user\\_hist\\_%")


MDE_GRID = (0.05, 0.1, 0.2)
_K = (z_quantile(1 - stats.ALPHA / 2) + z_quantile(stats.POWER)) ** 2

SAMPLE_SQL = f"""
SELECT run_id, baseline, mde,
       CASE WHEN baseline = baseline * (1 + mde) THEN cast(0 AS bigint)
            ELSE cast(trunc(2 * ((baseline + baseline * (1 + mde)) / 2) * (1 - ((baseline + baseline * (1 + mde)) / 2))
                            * cast('{_K!r}' AS double) / pow(baseline - baseline * (1 + mde), 2)) AS bigint) END AS n_per_group
FROM (SELECT run_id, cast(sum(conversions) AS double) / sum(users) AS baseline FROM ({AB_PRIMARY_SQL}) c GROUP BY run_id) b,
     (SELECT unnest([{', '.join(f'cast({m} AS double)' for m in MDE_GRID)}]) AS mde) g"""


def _designs(fx):
    c = metrics.ab_primary(fx.assignments, fx.events, "CTR")
    base = c.groupBy("run_id").agg((F.sum("conversions").cast("double") / F.sum("users")).alias("baseline"))
    grid = fx.spark.createDataFrame([(m,) for m in MDE_GRID], "mde double")
    # The grid has a fixed number of rows, so broadcasting it is bounded.
    return base.crossJoin(F.broadcast(grid))


@register("sample_size", SAMPLE_SQL, doubles=("baseline",))
def q_sample_size(fx):
    return stats.sample_size(_designs(fx))


SPLITS = (30, 50, 70)


@register("traffic_plan", f"""
SELECT *, cast(trunc(total_needed * (control_split_pct / 100.0)) AS bigint) AS control_n,
       cast(trunc(total_needed * (1 - control_split_pct / 100.0)) AS bigint) AS test_n,
       cast(trunc(total_needed / 500) AS bigint) AS days_needed
FROM (SELECT s.*, p.control_split_pct,
             CASE WHEN p.control_split_pct = 50 THEN n_per_group * 2
                  ELSE greatest(cast(trunc(n_per_group / (p.control_split_pct / 100.0)) AS bigint),
                                cast(trunc(n_per_group / (1 - p.control_split_pct / 100.0)) AS bigint)) END AS total_needed
      FROM ({SAMPLE_SQL}) s, (SELECT unnest([{', '.join(str(x) for x in SPLITS)}]) AS control_split_pct) p) t""",
          doubles=("baseline",))
def q_traffic_plan(fx):
    sizes = stats.sample_size(_designs(fx))
    splits = fx.spark.createDataFrame([(s,) for s in SPLITS], "control_split_pct int")
    return stats.traffic_plan(sizes.crossJoin(F.broadcast(splits)))


# ---------------------------------------------------------------- more read-outs

AB_PRIMARY_CVR_SQL = forms.converters(A, E, "bought")


@register("ab_stats_cvr", AB_STATS_SQL.replace(AB_PRIMARY_SQL, AB_PRIMARY_CVR_SQL),
          doubles=("control_rate", "test_rate", "lift", "se", "z_score", "p_value"))
def q_ab_stats_cvr(fx):
    return stats.ab_stats(metrics.ab_primary(fx.assignments, fx.events, "CVR"))


@register("user_metrics", f"""
SELECT run_id, variant, user_id, weight, times AS n_assign, cast(coalesce(hit, false) AS int) AS readout_click,
       cast(coalesce(any_hit, false) AS int) AS clicked, cast(coalesce(bought, false) AS int) AS purchased,
       cast(coalesce(left_early, false) AS int) AS bounced, times * spent AS revenue, times * steps AS n_events
FROM ({forms.in_run(A, E, ", weight")}) p""", doubles=("revenue",))
def q_user_metrics(fx):
    return metrics.user_metrics(fx.assignments, fx.events)


@register("live_visitors", """
SELECT run_id, variant, count(DISTINCT user_id) AS visitors
FROM fx_assignments WHERE run_id IS NOT NULL GROUP BY run_id, variant""")
def q_live_visitors(fx):
    return metrics.variant_users(fx.assignments)
