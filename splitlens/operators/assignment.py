"""Variant assignment: bucketing, the assignment rule, assign-once, baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.functions.hashing import DEFAULT_BUCKETS, DEFAULT_THRESHOLD, bucket_col, variant_col
from splitlens.operators.metrics import is_click_mart, is_purchase
from splitlens.sources.schemas import VARIANT_CONFIG

DEFAULT_BASELINE = 0.10


def bucket_users(users: DataFrame, n: int = DEFAULT_BUCKETS, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """(user_id, bucket, variant) for the distinct user ids of ``users``."""
    u = users.select(F.col("user_id").cast("string").alias("user_id")).distinct()
    b = bucket_col(F.col("user_id"), n)
    return u.select("user_id", b.alias("bucket"), variant_col(b, threshold).alias("variant"))


def latest_adoption(adoptions: DataFrame) -> DataFrame:
    """The newest adoption (ties: larger experiment id) as a one-row frame.
    A max_by aggregate: partial per task, no sort of the table."""
    row = F.struct(*[F.col(c) for c in adoptions.columns])
    key = F.struct("adopted_at", "experiment_id")
    top = adoptions.agg(F.max_by(row, key).alias("r"))
    return top.filter(F.col("r").isNotNull()).select("r.*")


def assignment_state(active: bool | None, adoptions: DataFrame | None,
                     active_experiment: DataFrame | None = None,
                     spark: SparkSession | None = None) -> DataFrame:
    """One-row state: ``active`` (an experiment is running) and ``winner`` (the
    adopted variant, NULL when none or the payload is invalid).

    ``active`` may be given directly or read from the active_experiment table
    (any row with is_active)."""
    if adoptions is not None:
        # A global aggregate: exactly one row, NULL winner when there is none.
        w = F.max_by(F.from_json("variant_config", VARIANT_CONFIG)["winning_variant"],
                     F.struct("adopted_at", "experiment_id"))
        state = adoptions.agg(w.alias("w")).select(F.when(F.length("w") > 0, F.col("w")).alias("winner"))
    else:
        spark = spark or SparkSession.getActiveSession()
        state = spark.range(1).select(F.lit(None).cast("string").alias("winner"))
    if active is None and active_experiment is not None:
        flag = active_experiment.agg(F.coalesce(F.max(F.col("is_active").cast("int")), F.lit(0)).alias("a"))
        state = state.crossJoin(flag).select((F.col("a") == 1).alias("active"), "winner")
    else:
        state = state.select(F.lit(bool(active)).alias("active"), "winner")
    return state


def apply_state(bucketed: DataFrame, state: DataFrame) -> DataFrame:
    """Variant per user from (user_id, bucket, variant) and the one-row state:
    running experiment -> bucket split; otherwise the adopted winner for
    everyone; with neither, the bucket split."""
    # ``state`` has exactly one row by construction: broadcasting it is bounded.
    j = bucketed.crossJoin(F.broadcast(state.select("active", "winner")))
    v = (F.when(F.col("active"), F.col("variant"))
         .when(F.col("winner").isNotNull(), F.col("winner"))
         .otherwise(F.col("variant")))
    return j.withColumn("variant", v).drop("active", "winner")


def assign_variant(users: DataFrame, state: DataFrame, n: int = DEFAULT_BUCKETS,
                   threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """(user_id, bucket, variant) for the distinct users under ``state``."""
    return apply_state(bucket_users(users, n, threshold), state)


# Stands for a NULL run in join keys (no run id is a NUL character), so that
# "same run or both NULL" becomes a plain equi-join key.
NULL_RUN = "\u0000"


def assign_once(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Assignments to insert: one per (user_id, run_id) -- the earliest request
    of the batch -- and only where the pair is not stored yet (a NULL run
    matches a NULL run).

    The batch grouping and the anti join use the same key (user_id, run_key),
    so each side is shuffled once; stored keys are distinct first (a partial
    aggregate), so repeated pairs cannot pile up on one join task."""
    run_key = F.coalesce(F.col("run_id"), F.lit(NULL_RUN)).alias("run_key")
    first = F.min(F.struct("assigned_at", "experiment_id", "variant", "weight", "run_id")).alias("f")
    batch = requests.groupBy("user_id", run_key).agg(first)
    keys = existing.select("user_id", run_key).distinct()
    return (batch.join(keys, ["user_id", "run_key"], "left_anti")
            .select("user_id", "f.run_id", "f.assigned_at", "f.experiment_id", "f.variant", "f.weight"))


def baseline_rates(assignments: DataFrame, events: DataFrame, by=("run_id",), user_like: str | None = None,
                   default: float = DEFAULT_BASELINE) -> DataFrame:
    """Baseline click-through (click_banner) and purchase rates of assigned
    users, joined to *all* their events on user id; 0 or no data -> default.

    The user-only join fans out in row form; here events fold to one row per
    user first, so the join is one-to-one on the events side."""
    name = F.col("event_name")
    ev = events.groupBy("user_id").agg(
        F.max(F.when(is_click_mart(name), 1).otherwise(0)).alias("clicked"),
        F.max(F.when(is_purchase(name), 1).otherwise(0)).alias("purchased"))
    a = assignments
    if user_like:
        a = a.filter(F.col("user_id").like(user_like))
        ev = ev.filter(F.col("user_id").like(user_like))
    keys = list(by)
    # Repeated assignments fold away before the join.
    per_user = a.select(*keys, "user_id").distinct().join(ev, "user_id", "left").fillna(0, ["clicked", "purchased"])
    n = F.count(F.lit(1)).cast("double")

    def rate(flag):
        r = F.sum(flag).cast("double") / F.nullif(n, F.lit(0.0))
        return F.coalesce(F.nullif(r, F.lit(0.0)), F.lit(default))

    return per_user.groupBy(*keys).agg(rate("clicked").alias("ctr_baseline"),
                                       rate("purchased").alias("cvr_baseline"))
