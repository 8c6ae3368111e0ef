"""Experiment metrics per (run, variant) for every run at once.

Plan shape (the same for every read-out here):

1. events of runs are pre-aggregated per ``(run_id, user_id)`` into flags,
   revenue and event counts -- a partial (map-side) aggregate, so a hot user
   or a hot run costs nothing extra;
2. assignments are joined to that on ``(run_id, user_id)``; both sides are
   hash-partitioned on those keys, and the later groupings that contain them
   reuse the partitioning (no further exchange);
3. users are counted once per ``(run, variant)`` by grouping on the user
   first, which replaces ``COUNT(DISTINCT CASE ...)`` (an ``Expand`` plus two
   shuffles) by plain sums.

Duplicated assignment rows keep the exact semantics of the row-level join:
flags are maxima, revenue and depth are multiplied by the number of
assignment rows, user counts stay distinct.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed event names of the modelled application.
CLICK_BANNER = "click_banner"
PURCHASE = "purchase"
BOUNCE = "bounce"


def is_click_readout(name: Column) -> Column:
    """Click as the primary read-out counts it: click_banner or banner_<x>."""
    return (name == CLICK_BANNER) | name.like("banner_%")


def is_click_any(name: Column) -> Column:
    """Click as guardrails and weighted metrics count it: banner* or click_banner."""
    return name.like("banner%") | (name == CLICK_BANNER)


def is_click_mart(name: Column) -> Column:
    """Click as the KPI mart and the baseline count it: click_banner only."""
    return name == CLICK_BANNER


def is_purchase(name: Column) -> Column:
    return name == PURCHASE


def is_bounce(name: Column) -> Column:
    return name == BOUNCE


@dataclass(frozen=True)
class MetricSpec:
    """A conversion metric: a user converts if any event satisfies ``predicate``."""
    name: str
    predicate: Callable[[Column], Column]
    description: str = ""


# Metric -> event predicate (the read-out's metric/event mapping; Bounce uses
# its own event instead of silently falling back to clicks).
METRICS: dict[str, MetricSpec] = {
    "CTR": MetricSpec("CTR", is_click_readout, "users with a banner click / users"),
    "CVR": MetricSpec("CVR", is_purchase, "users with a purchase / users"),
    "AOV": MetricSpec("AOV", is_purchase, "purchasers (revenue per purchaser uses them)"),
    "Bounce": MetricSpec("Bounce", is_bounce, "users with a bounce / users"),
}


def metric_spec(metric: str | MetricSpec) -> MetricSpec:
    if isinstance(metric, MetricSpec):
        return metric
    for key, spec in METRICS.items():
        if key.lower() == metric.lower() or metric.upper().startswith(key.upper()):
            return spec
    raise ValueError(f"unknown metric {metric!r}; one of {', '.join(METRICS)}")


def _flag(pred: Column) -> Column:
    return F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def run_user_events(events: DataFrame, predicates: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Events of runs folded to one row per (run_id, user_id)."""
    name = F.col("event_name")
    aggs = [_flag(p(name)).alias(k) for k, p in predicates.items()]
    aggs += [F.sum(F.when(is_purchase(name), F.col("value")).otherwise(F.lit(0.0))).alias("ev_revenue"),
             F.count(name).alias("ev_events")]
    return (events.filter(F.col("run_id").isNotNull())
            .groupBy("run_id", "user_id").agg(*aggs))


# Every read-out flag, folded in one pass: the read-outs below share this
# fold, so a plan that needs several of them (e.g. the experiment record)
# reuses one events exchange instead of folding the events again.
ALL_FLAGS = {"readout_click": is_click_readout, "clicked": is_click_any,
             "purchased": is_purchase, "bounced": is_bounce}
SPEC_FLAG = {"CTR": "readout_click", "CVR": "purchased", "AOV": "purchased", "Bounce": "bounced"}


def _joined(assignments: DataFrame, events: DataFrame, predicates=None, run_ids=None) -> DataFrame:
    a = assignments.filter(F.col("run_id").isNotNull())
    e = events
    if run_ids is not None:
        a = a.filter(F.col("run_id").isin(list(run_ids)))
        e = e.filter(F.col("run_id").isin(list(run_ids)))
    a = a.select("run_id", "variant", "user_id", "weight")
    return a.join(run_user_events(e, predicates or ALL_FLAGS), ["run_id", "user_id"], "left")


def _max0(c: str) -> Column:
    return F.coalesce(F.max(c), F.lit(0)).alias(c)


def _sum0(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(c)


def user_metrics(assignments: DataFrame, events: DataFrame, run_ids=None) -> DataFrame:
    """One row per (run_id, variant, user_id, weight): n_assign, the flags
    readout_click/clicked/purchased/bounced, revenue and n_events (both
    multiplied by n_assign, as the row-level join would)."""
    j = _joined(assignments, events, None, run_ids)
    return (j.groupBy("run_id", "variant", "user_id", "weight")
            .agg(F.count(F.lit(1)).alias("n_assign"),
                 *[_max0(k) for k in ALL_FLAGS],
                 _sum0("ev_revenue"), F.coalesce(F.sum("ev_events"), F.lit(0)).alias("ev_events"))
            .withColumnRenamed("ev_revenue", "revenue")
            .withColumnRenamed("ev_events", "n_events"))


def _per_user(assignments: DataFrame, events: DataFrame, run_ids=None) -> DataFrame:
    """(run_id, variant, user_id): flags and revenue from the shared fold."""
    j = _joined(assignments, events, None, run_ids)
    return j.groupBy("run_id", "variant", "user_id").agg(*[_max0(k) for k in ALL_FLAGS], _sum0("ev_revenue"))


def ab_primary(assignments: DataFrame, events: DataFrame, metric: str | MetricSpec = "CTR",
               run_ids=None) -> DataFrame:
    """(run_id, variant, users, conversions): distinct assigned users and
    distinct users with a converting event in the same run."""
    spec = metric_spec(metric)
    flag = SPEC_FLAG.get(spec.name) if METRICS.get(spec.name) is spec else None
    if flag is None:
        # A custom metric: its own fold.
        j = _joined(assignments, events, {"conv": spec.predicate}, run_ids)
        per_user = j.groupBy("run_id", "variant", "user_id").agg(_max0("conv"))
    else:
        per_user = _per_user(assignments, events, run_ids).withColumnRenamed(flag, "conv")
    return (per_user.groupBy("run_id", "variant")
            .agg(F.count(F.lit(1)).alias("users"), F.sum("conv").cast("long").alias("conversions")))


def guardrail_counts(assignments: DataFrame, events: DataFrame, run_ids=None) -> DataFrame:
    """(run_id, variant, users, conversions, revenue, clicks, bounces) in one pass."""
    per_user = _per_user(assignments, events, run_ids)
    return (per_user.groupBy("run_id", "variant")
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum("purchased").cast("long").alias("conversions"),
                 F.sum("ev_revenue").alias("revenue"),
                 F.sum("clicked").cast("long").alias("clicks"),
                 F.sum("bounced").cast("long").alias("bounces")))


def run_outcomes(assignments: DataFrame, events: DataFrame, run_ids=None) -> DataFrame:
    """Every read-out count per (run_id, variant) in one aggregate: users,
    readout (primary-metric converters), conversions (purchasers), revenue,
    clicks, bounces -- the input of a one-pass experiment record."""
    per_user = _per_user(assignments, events, run_ids)
    return (per_user.groupBy("run_id", "variant")
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum("readout_click").cast("long").alias("readout"),
                 F.sum("purchased").cast("long").alias("conversions"),
                 F.sum("ev_revenue").alias("revenue"),
                 F.sum("clicked").cast("long").alias("clicks"),
                 F.sum("bounced").cast("long").alias("bounces")))


def weighted_metrics(assignments: DataFrame, events: DataFrame, run_ids=None) -> DataFrame:
    """Weight-adjusted metric table per (run_id, variant): every sampled user
    counts ``weight`` times.  Rounding and integer casts as in the read-out."""
    j = _joined(assignments, events, None, run_ids)
    per_user = (j.groupBy("run_id", "variant", "user_id", "weight")
                .agg(_max0("clicked"), _max0("purchased"), _sum0("ev_revenue")))
    w = F.col("weight")

    def people(flag):
        return F.sum(F.when(F.col(flag) == 1, w).otherwise(F.lit(0.0)))

    def whole(x):
        # Doubles added in another order differ past the sixth place; sums that
        # lie on .5 must not round either way because of that.
        return F.round(F.round(x, 6), 0).cast("long")

    sums = per_user.groupBy("run_id", "variant").agg(
        F.sum(w).alias("sw"), people("clicked").alias("sc"), people("purchased").alias("sb"),
        F.sum(F.col("ev_revenue") * w).alias("sr"))
    sw, sc, sb, sr = (F.col(c) for c in ("sw", "sc", "sb", "sr"))
    none = F.lit(0.0)
    return sums.select(
        "run_id", "variant", whole(sw).alias("visitors"), whole(sc).alias("clicks"), whole(sb).alias("buyers"),
        whole(sr).alias("revenue"), F.round(sc / F.nullif(sw, none) * 100, 2).alias("ctr"),
        F.round(sb / F.nullif(sw, none) * 100, 2).alias("cvr"),
        whole(sr / F.nullif(sb, none)).alias("aov"), whole(sr / F.nullif(sw, none)).alias("arpu"))


def variant_users(assignments: DataFrame) -> DataFrame:
    """Distinct users per (run, variant) -- the live visitor count."""
    return (assignments.filter(F.col("run_id").isNotNull())
            .groupBy("run_id", "variant").agg(F.count_distinct("user_id").alias("visitors")))
