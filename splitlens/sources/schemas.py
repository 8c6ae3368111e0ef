"""Explicit schemas of the experiment data model (no inference anywhere).

Two namespaces as in the modelled application: ``warehouse`` (users, orders)
and ``experiment`` (assignments, events, experiments, adoptions,
active_experiment, dm_daily_kpi).  Ratios that the application stored as
FLOAT are DOUBLE here.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, DT = T.TimestampNTZType(), T.DateType()


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _s(("user_id", S), ("name", S), ("gender", S), ("age", I), ("job", S),
           ("segment", S), ("joined_at", TS))
ORDERS = _s(("order_id", S), ("user_id", S), ("order_at", TS), ("menu_item", S), ("amount", D))
ASSIGNMENTS = _s(("user_id", S), ("experiment_id", S), ("variant", S), ("assigned_at", TS),
                 ("run_id", S), ("weight", D))
EVENTS = _s(("event_id", S), ("user_id", S), ("event_name", S), ("timestamp", TS),
            ("value", D), ("run_id", S))
EXPERIMENTS = _s(("exp_id", L), ("target", S), ("hypothesis", S), ("primary_metric", S),
                 ("guardrails", S), ("sample_size", L), ("start_date", DT), ("end_date", DT),
                 ("traffic_split", D), ("p_value", D), ("decision", S), ("learning_note", S),
                 ("run_id", S), ("control_rate", D), ("test_rate", D), ("lift", D),
                 ("guardrail_results", S), ("created_at", TS))
ADOPTIONS = _s(("experiment_id", S), ("variant_config", S), ("adopted_at", TS))
ACTIVE_EXPERIMENT = _s(("id", I), ("is_active", B), ("started_at", TS))
DAILY_KPI = _s(("report_date", DT), ("total_users", L), ("click_count", L), ("total_orders", L),
               ("total_revenue", D), ("ctr", D), ("cvr", D), ("aov", D), ("arpu", D),
               ("session_depth", D), ("updated_at", T.TimestampType()))

# JSON payloads.  Settings of an adopted variant keep their JSON types: numbers, booleans, nested objects.
VARIANT_CONFIG = T.StructType([
    T.StructField("winning_variant", S), T.StructField("target", S),
    T.StructField("config", T.MapType(S, T.VariantType())), T.StructField("lift", D),
    T.StructField("p_value", D)])
GUARDRAIL_RESULT = T.StructType([
    T.StructField("metric", S), T.StructField("control", D), T.StructField("test", D),
    T.StructField("lift", D), T.StructField("passed", B)])
GUARDRAIL_RESULTS = T.ArrayType(GUARDRAIL_RESULT)

WAREHOUSE = {"users": USERS, "orders": ORDERS}
EXPERIMENT = {"assignments": ASSIGNMENTS, "events": EVENTS, "experiments": EXPERIMENTS,
              "adoptions": ADOPTIONS, "active_experiment": ACTIVE_EXPERIMENT,
              "dm_daily_kpi": DAILY_KPI}
CATALOGUE = {"warehouse": WAREHOUSE, "experiment": EXPERIMENT}

# Partition columns used when the tables are written by this library: a run's
# read-out opens the run, the live screens open the newest days, and deleting a
# run drops its partitions.
PARTITIONING = {"events": ["run_id", "event_date"], "assignments": ["run_id"], "dm_daily_kpi": ["report_date"]}
