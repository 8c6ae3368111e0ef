"""Registered queries: schema evolution, deletes, copies and table health
(frame forms; the writes themselves are exercised in the tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from splitlens.operators import maintenance
from splitlens.plans.catalog import register
from splitlens.sources.schemas import ASSIGNMENTS

DELETED_RUN = "run_20240110"
COPIED_UNTIL = "run_20240115"


@register("evolve_assignments", """
SELECT user_id, experiment_id, variant, assigned_at, run_id, cast(1.0 AS double) AS weight FROM fx_assignments""")
def q_evolve_assignments(fx):
    # An older table without the weight column, brought to the current schema.
    return maintenance.evolve(fx.assignments.drop("weight"), ASSIGNMENTS)


@register("delete_run", f"""
SELECT * FROM fx_assignments WHERE NOT coalesce(run_id = '{DELETED_RUN}', false)""")
def q_delete_run(fx):
    return maintenance.delete_rows(fx.assignments, F.col("run_id") == DELETED_RUN)


@register("copy_new_rows", f"""
SELECT * FROM fx_assignments s
WHERE NOT EXISTS (SELECT 1 FROM fx_assignments d
                  WHERE d.run_id <= '{COPIED_UNTIL}' AND d.user_id = s.user_id AND d.run_id = s.run_id)""")
def q_copy_new_rows(fx):
    already = fx.assignments.filter(F.col("run_id") <= COPIED_UNTIL)
    return maintenance.copy_new_rows(fx.assignments, already, ["user_id", "run_id"])


@register("table_health", """
SELECT 'assignments' AS table_name, count(*) AS row_count, true AS present FROM fx_assignments
UNION ALL SELECT 'events', count(*), true FROM fx_events
UNION ALL SELECT 'users', count(*), true FROM fx_users
UNION ALL SELECT 'orders', count(*), true FROM fx_orders
UNION ALL SELECT 'experiments', count(*), true FROM fx_experiments
UNION ALL SELECT 'adoptions', count(*), true FROM fx_adoptions
UNION ALL SELECT 'active_experiment', 0, false
UNION ALL SELECT 'dm_daily_kpi', 0, false""")
def q_table_health(fx):
    return maintenance.table_health({
        "assignments": fx.assignments, "events": fx.events, "users": fx.users, "orders": fx.orders,
        "experiments": fx.experiments, "adoptions": fx.adoptions,
        "active_experiment": None, "dm_daily_kpi": None})
