"""Daily KPI mart and the daily ETL variant.

Both join assignments to events on the user; the mart also on the calendar
day.  Instead of joining row to row (which multiplies every event by every
assignment of the user and needs ``COUNT(DISTINCT ...)`` per metric), each
side is first folded:

* events  -> one row per (user_id, day) or per user_id: flags, revenue,
  event count (partial aggregation, so a hot user such as a shared anonymous
  id costs one row per map task);
* assignments -> one row per (user_id, day) with ``n_assign`` rows.

The join is then one-to-one and every metric is a plain sum; revenue and
depth are multiplied by ``n_assign`` exactly as the row-level join would.
Both folds hash-partition on the join keys, so the join needs no further
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.operators.metrics import is_click_mart, is_purchase

OPTIONAL_METRICS = ("revenue", "ctr", "cvr", "aov", "arpu", "session_depth")
BASE_COLUMNS = ("report_date", "total_users", "click_count", "total_orders")


def _event_fold(events: DataFrame, keys: list) -> DataFrame:
    name = F.col("event_name")
    return events.groupBy(*keys).agg(
        F.max(F.when(is_click_mart(name), 1).otherwise(0)).alias("clicked"),
        F.max(F.when(is_purchase(name), 1).otherwise(0)).alias("purchased"),
        F.sum(F.when(is_purchase(name), F.col("value")).otherwise(F.lit(0.0))).alias("revenue"),
        F.count(name).alias("n_events"))


def _assignment_fold(assignments: DataFrame) -> DataFrame:
    return (assignments.groupBy("user_id", F.to_date("assigned_at").alias("report_date"))
            .agg(F.count(F.lit(1)).alias("n_assign")))


def _per_day(j: DataFrame) -> DataFrame:
    n = F.col("n_assign")
    return j.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("clicked"), F.lit(0)).cast("long").alias("click_count"),
        F.coalesce(F.sum("purchased"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.sum(F.col("revenue") * n), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum(F.col("n_events") * n), F.lit(0)).cast("long").alias("_events"))


def build_mart(assignments: DataFrame, events: DataFrame, metrics=OPTIONAL_METRICS,
               dedup_assignments: bool = False, baseline_only: bool = False) -> DataFrame:
    """Daily KPI mart: report_date, total_users, click_count, total_orders and
    the selected optional metrics.  ``dedup_assignments`` counts a user once
    per day however many assignment rows they have (the default keeps the
    row-level join's multiplication); ``baseline_only`` keeps only traffic
    outside experiment runs (run_id IS NULL)."""
    if baseline_only:
        assignments = assignments.filter(F.col("run_id").isNull())
        events = events.filter(F.col("run_id").isNull())
    a = _assignment_fold(assignments)
    if dedup_assignments:
        a = a.withColumn("n_assign", F.lit(1).cast("long"))
    e = _event_fold(events.withColumn("report_date", F.to_date("timestamp")), ["user_id", "report_date"])
    return finish_mart(a.join(e, ["user_id", "report_date"], "left"), metrics)


def finish_mart(user_days: DataFrame, metrics=OPTIONAL_METRICS) -> DataFrame:
    """The mart of one row per (report_date, assigned user) with both folds' columns."""
    d = _per_day(user_days)
    users = F.nullif(F.col("total_users"), F.lit(0)).cast("double")
    orders = F.nullif(F.col("total_orders"), F.lit(0)).cast("double")
    optional = {
        "revenue": F.col("total_revenue").alias("total_revenue"),
        "ctr": (F.col("click_count") / users).alias("ctr"),
        "cvr": (F.col("total_orders") / users).alias("cvr"),
        "aov": F.coalesce(F.col("total_revenue") / orders, F.lit(0.0)).alias("aov"),
        "arpu": F.coalesce(F.col("total_revenue") / users, F.lit(0.0)).alias("arpu"),
        "session_depth": (F.col("_events") / users).alias("session_depth"),
    }
    chosen = [optional[m] for m in OPTIONAL_METRICS if m in set(metrics)]
    return d.select(*BASE_COLUMNS, *chosen)


def build_etl_mart(assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Daily ETL variant: events joined on the user only (any day), NULL dates
    dropped, cvr = buyers / clickers, aov NULL when there are no buyers.

    Both sides are folded before they meet: a hot user is one row of events
    and one row per day of assignments."""
    a = _assignment_fold(assignments.filter(F.col("assigned_at").isNotNull()))
    per_user_day = a.join(_event_fold(events, ["user_id"]), "user_id", "left")
    d = _per_day(per_user_day)
    clicks = F.nullif(F.col("click_count"), F.lit(0)).cast("double")
    orders = F.nullif(F.col("total_orders"), F.lit(0)).cast("double")
    return d.select(
        "report_date", "total_users", "total_revenue", "total_orders", "click_count",
        (F.col("click_count") / F.nullif(F.col("total_users"), F.lit(0)).cast("double")).alias("ctr"),
        (F.col("total_orders") / clicks).alias("cvr"),
        (F.col("total_revenue") / orders).alias("aov"))


def with_updated_at(mart: DataFrame) -> DataFrame:
    """Stamp for writes (kept out of query results: it is not deterministic)."""
    return mart.withColumn("updated_at", F.current_timestamp())
