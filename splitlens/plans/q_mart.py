"""Registered queries: KPI mart, ETL mart and the monitoring screens."""

from __future__ import annotations

from splitlens.operators import mart, monitor
from splitlens.plans import oracle_forms as forms
from splitlens.plans.catalog import register

AS_OF = "2024-01-30 12:00:00"
# Alert thresholds for the registered check.  The rules and defaults are the
# dashboard's (CTR < 5 %, revenue < 70 % of the day before, CVR < 1 %); the
# derived data never has CTR below 5 %, so the check uses levels that fire.
ALERT_CTR, ALERT_REV, ALERT_CVR = 0.22, 0.8, 0.38

A, E = "fx_assignments", "fx_events"
HARD_A, HARD_E = "fx_hard_assignments", "fx_hard_events"
MART_SQL = forms.mart(A, E)

MART_DOUBLES = ("total_revenue", "ctr", "cvr", "aov", "arpu", "session_depth")


def _mart(fx):
    return mart.build_mart(fx.assignments, fx.events)


@register("kpi_mart", MART_SQL, doubles=MART_DOUBLES)
def q_kpi_mart(fx):
    return _mart(fx)


@register("kpi_mart_min", f"SELECT report_date, total_users, click_count, total_orders FROM ({MART_SQL}) mart")
def q_kpi_mart_min(fx):
    return mart.build_mart(fx.assignments, fx.events, metrics=())


@register("kpi_etl", forms.etl(A, E), doubles=("total_revenue", "ctr", "cvr", "aov"), digits=6)
def q_kpi_etl(fx):
    return mart.build_etl_mart(fx.assignments, fx.events)


TOP2 = f"""mart AS ({MART_SQL}),
m AS (SELECT * FROM mart WHERE report_date IS NOT NULL),
top2 AS (SELECT * FROM m ORDER BY report_date DESC LIMIT 2),
cur AS (SELECT * FROM top2 ORDER BY report_date DESC LIMIT 1),
prev AS (SELECT * FROM top2 ORDER BY report_date ASC LIMIT 1)"""


@register("kpi_cards", f"""
WITH {TOP2}
SELECT (SELECT avg(total_revenue) FROM m) AS avg_revenue, (SELECT avg(aov) FROM m) AS avg_aov,
       cur.report_date AS latest_date, cur.cvr AS latest_cvr,
       cast(trunc(cur.total_revenue - prev.total_revenue) AS bigint) AS revenue_delta,
       cast(trunc(cur.aov - prev.aov) AS bigint) AS aov_delta,
       cur.cvr - prev.cvr AS cvr_delta
FROM cur, prev""", doubles=("avg_revenue", "avg_aov", "latest_cvr", "cvr_delta"))
def q_kpi_cards(fx):
    return monitor.kpi_cards(_mart(fx))


@register("kpi_funnel", f"""
WITH {TOP2}
SELECT report_date, 1 AS step, 'Total Users' AS stage, total_users AS users FROM cur
UNION ALL SELECT report_date, 2, 'Clicks', click_count FROM cur
UNION ALL SELECT report_date, 3, 'Orders', total_orders FROM cur""")
def q_kpi_funnel(fx):
    return monitor.kpi_funnel(_mart(fx))


@register("kpi_alerts", f"""
WITH mart AS ({MART_SQL}),
m AS (SELECT *, lag(total_revenue) OVER (ORDER BY report_date) AS prev_rev FROM mart WHERE report_date IS NOT NULL)
SELECT report_date, 'Critical' AS level, 'ctr' AS metric, ctr AS value, cast({ALERT_CTR} AS double) AS threshold,
       cast(NULL AS double) AS drop_pct FROM m WHERE ctr < {ALERT_CTR}
UNION ALL
SELECT report_date, 'Warning', 'total_revenue', total_revenue, NULL, (1 - total_revenue / prev_rev) * 100
FROM m WHERE prev_rev > 0 AND total_revenue / prev_rev < {ALERT_REV}
UNION ALL
SELECT report_date, 'Critical', 'cvr', cvr, cast({ALERT_CVR} AS double), NULL FROM m WHERE cvr < {ALERT_CVR}""",
          doubles=("value", "threshold", "drop_pct"))
def q_kpi_alerts(fx):
    return monitor.kpi_alerts(_mart(fx), ctr_min=ALERT_CTR, revenue_ratio_min=ALERT_REV, cvr_min=ALERT_CVR)


@register("kpi_threshold_series", f"""
SELECT report_date, 'ctr' AS metric, ctr AS value, cast({ALERT_CTR} AS double) AS threshold,
       CASE WHEN cast({ALERT_CTR} AS double) IS NULL THEN false ELSE ctr < {ALERT_CTR} END AS breached
FROM ({MART_SQL}) mart""", doubles=("value", "threshold"))
def q_kpi_threshold_series(fx):
    return monitor.kpi_threshold_series(_mart(fx), "ctr", ALERT_CTR)


@register("live_pulse", f"""
SELECT count(DISTINCT CASE WHEN timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 30 MINUTE THEN user_id END) AS active_users,
       count(CASE WHEN event_name = 'purchase' AND timestamp >= cast(cast(TIMESTAMP '{AS_OF}' AS date) AS timestamp)
                  THEN 1 END) AS today_orders,
       coalesce(sum(CASE WHEN event_name = 'purchase' AND timestamp >= cast(cast(TIMESTAMP '{AS_OF}' AS date) AS timestamp)
                    THEN value END), 0) AS today_revenue
FROM fx_events
WHERE timestamp <= TIMESTAMP '{AS_OF}'
  AND timestamp >= least(TIMESTAMP '{AS_OF}' - INTERVAL 30 MINUTE, cast(cast(TIMESTAMP '{AS_OF}' AS date) AS timestamp))""",
          doubles=("today_revenue",))
def q_live_pulse(fx):
    return monitor.live_pulse(fx.events, AS_OF)


@register("recent_events", """
SELECT event_id, user_id, event_name, value, timestamp, run_id, rank,
       strftime(timestamp, '%H:%M:%S') AS time, right(user_id, 4) AS user_suffix,
       CASE WHEN event_name = 'purchase'
            THEN concat('Purchase (User_', right(user_id, 4), ': ', cast(cast(trunc(value) AS bigint) AS varchar), ')')
            ELSE concat('Action: ', event_name) END AS label
FROM (SELECT *, cast(row_number() OVER (PARTITION BY run_id ORDER BY timestamp DESC, event_id DESC) AS int) AS rank
      FROM fx_events WHERE run_id IS NOT NULL) t
WHERE rank <= 5""")
def q_recent_events(fx):
    return monitor.recent_events(fx.events, k=5, by="run_id")


@register("active_runs", """
SELECT DISTINCT run_id FROM fx_assignments WHERE run_id IS NOT NULL ORDER BY run_id DESC LIMIT 5""")
def q_active_runs(fx):
    return monitor.active_runs(fx.assignments, k=5)


@register("run_progress", """
WITH per AS (SELECT run_id, variant, count(*) AS assignments, count(DISTINCT user_id) AS visitors,
                    sum(weight) AS weighted_visitors
             FROM fx_assignments WHERE run_id IS NOT NULL GROUP BY run_id, variant),
runs AS (SELECT run_id, cast(sum(assignments) AS bigint) AS run_assignments, sum(weighted_visitors) AS w
         FROM per GROUP BY run_id)
SELECT per.run_id, per.variant, per.assignments, per.visitors, per.weighted_visitors,
       runs.run_assignments, cast(trunc(runs.w) AS bigint) AS effective_assignments,
       least(cast(runs.run_assignments AS double) / 100, 1.0) AS progress
FROM per JOIN runs ON per.run_id = runs.run_id""", doubles=("weighted_visitors", "progress"))
def q_run_progress(fx):
    return monitor.run_progress(fx.assignments, needed=100)


@register("prefix_counts", """
SELECT * FROM
  (SELECT count(*) FILTER (WHERE starts_with(event_name, 'banner')) AS banner_events,
          count(*) FILTER (WHERE starts_with(event_name, 'banner') AND length(event_name) > 6) AS banner_underscore_events
   FROM fx_hard_events) e,
  (SELECT count(*) FILTER (WHERE starts_with(user_id, 'user_hist_')) AS history_assignments,
          count(*) FILTER (WHERE starts_with(user_id, 'agent_')) AS agent_assignments FROM fx_hard_assignments) a""")
def q_prefix_counts(fx):
    return monitor.prefix_counts(fx.hard_events, fx.hard_assignments)


# Repeated assignments: a guest's revenue and steps count once per assignment...
@register("kpi_mart_repeated", forms.mart(HARD_A, HARD_E), doubles=MART_DOUBLES, digits=6)
def q_kpi_mart_repeated(fx):
    return mart.build_mart(fx.hard_assignments, fx.hard_events)


# ... or once per user and day.
@register("kpi_mart_dedup", forms.mart(HARD_A, HARD_E, "1"), doubles=MART_DOUBLES, digits=6)
def q_kpi_mart_dedup(fx):
    return mart.build_mart(fx.hard_assignments, fx.hard_events, dedup_assignments=True)


@register("kpi_alerts_latest", f"""
WITH mart AS ({MART_SQL}),
m AS (SELECT *, lag(total_revenue) OVER (ORDER BY report_date) AS prev_rev FROM mart WHERE report_date IS NOT NULL),
a AS (
SELECT report_date, 'Critical' AS level, 'ctr' AS metric, ctr AS value, cast({ALERT_CTR} AS double) AS threshold,
       cast(NULL AS double) AS drop_pct FROM m WHERE ctr < {ALERT_CTR}
UNION ALL
SELECT report_date, 'Warning', 'total_revenue', total_revenue, NULL, (1 - total_revenue / prev_rev) * 100
FROM m WHERE prev_rev > 0 AND total_revenue / prev_rev < {ALERT_REV}
UNION ALL
SELECT report_date, 'Critical', 'cvr', cvr, cast({ALERT_CVR} AS double), NULL FROM m WHERE cvr < {ALERT_CVR})
SELECT * FROM a WHERE report_date = (SELECT max(report_date) FROM m)""", doubles=("value", "threshold", "drop_pct"))
def q_kpi_alerts_latest(fx):
    return monitor.kpi_alerts(_mart(fx), ctr_min=ALERT_CTR, revenue_ratio_min=ALERT_REV, cvr_min=ALERT_CVR,
                              latest_only=True)


@register("daily_purchases", """
SELECT cast(timestamp AS date) AS day, count(*) AS orders, coalesce(sum(value), 0) AS revenue
FROM fx_events WHERE event_name = 'purchase' GROUP BY 1""", doubles=("revenue",))
def q_daily_purchases(fx):
    return monitor.daily_purchases(fx.events)


@register("active_users_windows", """
WITH w AS (
  SELECT user_id,
         make_timestamp(cast((floor(epoch_us(timestamp) / 300000000) - k) * 300000000 AS BIGINT)) AS window_start
  FROM fx_events, (SELECT unnest(range(0, 6)) AS k) ks)
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, count(DISTINCT user_id) AS active_users
FROM w GROUP BY window_start""")
def q_active_users_windows(fx):
    return monitor.active_users_windows(fx.events)


@register("recent_events_latest", """
SELECT event_id, user_id, event_name, value, timestamp, run_id, cast(NULL AS int) AS rank,
       strftime(timestamp, '%H:%M:%S') AS time, right(user_id, 4) AS user_suffix,
       CASE WHEN event_name = 'purchase'
            THEN concat('Purchase (User_', right(user_id, 4), ': ', cast(cast(trunc(value) AS bigint) AS varchar), ')')
            ELSE concat('Action: ', event_name) END AS label
FROM fx_events ORDER BY timestamp DESC, event_id DESC LIMIT 3""")
def q_recent_events_latest(fx):
    return monitor.recent_events(fx.events, k=3)
