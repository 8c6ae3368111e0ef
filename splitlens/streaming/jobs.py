"""Structured Streaming jobs for the live screens.

The modelled application polls its tables every second; here the same
numbers are maintained incrementally:

* T1 ``start_ingest``      -- foreachBatch: append the events that are not
                              stored yet, however late and whatever their
                              dates (``ledger``);
* T2 ``active_users``      -- distinct users per sliding 30-minute window,
                              exact: (5-minute slot, user) first, copied to
                              its windows after;
* T3 ``daily_purchases``   -- purchases and revenue per day;
* T4 ``start_assign_once`` -- foreachBatch: first assignment per (user, run),
                              checked against the stored ones;
* T5 ``live_visitors``     -- visitors per (run, variant) of what T4 stored, as a
                              stream in ``visitors``;
* T6 ``start_mart_refresh``-- foreachBatch: rebuild the days a batch touched
                              from the tables as they are then, replace those
                              partitions (idempotent on replay); incrementally in
                              ``folds``;
* T7 ``start_live_mart``   -- T1 and T6 in one batch: late rows, which the
                              watermarks of T2/T3 drop, reach the mart.

Watermarks need a zoned TIMESTAMP; the zone-less event time is cast under the
session's UTC zone, which keeps the wall-clock value.  Checkpoints live under
the cluster's shared checkpoint folder (``checkpoint_location``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitlens.operators import mart as mart_ops
from splitlens.operators.assignment import assign_once as assign_new
from splitlens.operators.metrics import variant_users
from splitlens.session import checkpoint_dir
from splitlens.sources.schemas import EVENTS
from splitlens.sources.sinks import insert_by_name, overwrite_partitions, staged, table_schema
from splitlens.streaming import segments
from splitlens.streaming.ledger import Ledger, append_unstored, one_per_id, store_once
from splitlens.streaming.segments import stored

EVENT_TIME = "event_time"


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def read_stream(spark: SparkSession, path: str, schema: T.StructType = EVENTS, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def with_event_time(df: DataFrame, ts_col: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    return df.withColumn(EVENT_TIME, F.col(ts_col).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def store_events(batch: DataFrame, target: str, ledger: str | None = None, segment: str | None = None) -> None:
    """T1 for one micro-batch: the events that ``target`` does not hold yet.

    However late an event is, it is stored; one that was sent twice, in one
    batch or in different ones, is stored once; a batch that runs again stores
    nothing new.  With a ``ledger`` folder (and the batch's ``segment``), an id is known for all time, whatever its
    dates; without one, only the dates of the batch are looked up."""
    if ledger is not None:
        store_once(batch, target, seeded(batch.sparkSession, target, ledger), segment)
        return
    spark = batch.sparkSession
    new = one_per_id(batch).withColumn("event_date", F.to_date("timestamp"))
    append_unstored(new, target, spark)


def seeded(spark: SparkSession, target: str, folder: str) -> Ledger:
    """The ledger in ``folder``; the ids that ``target`` held before there was one are its first segment."""
    ledger = Ledger(spark, folder)
    if ledger.is_empty():
        held = stored(spark, target, table_schema("events"))
        if held is not None:
            ledger.add(held.select("event_id"), "seed")
    return ledger


def default_ledger(spark: SparkSession, target: str) -> str:
    return checkpoint_location(spark, "ids-" + target.strip("/").replace("/", "_").replace(":", "_"))


def _start(stream: DataFrame, checkpoint: str, each_batch, trigger: dict | None):
    def run(batch, batch_id):
        batch.persist()
        try:
            each_batch(batch, segments.name_of(checkpoint, batch_id))
        finally:
            batch.unpersist()

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return (w.trigger(**trigger) if trigger else w).start()


def start_ingest(events: DataFrame, target: str, checkpoint: str, trigger: dict | None = None, ledger: str | None = None):
    """T1: store the stream's events in ``target`` (table or folder), each id once for all
    time; ``ledger`` names the folder of known ids (default: beside the streams' checkpoints)."""
    ids = ledger or default_ledger(events.sparkSession, target)
    return _start(events, checkpoint, lambda b, segment: store_events(b, target, ids, segment), trigger)


def active_users(events: DataFrame, window: str = "30 minutes", slide: str = "5 minutes",
                 delay: str = "10 minutes", approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """T2: (window_start, window_end, active_users), append mode: a window is
    emitted once the watermark passes its end.  Exact by default (state: one
    row per window and user); ``approx=True`` keeps one HyperLogLog sketch per
    window instead (relative error ``rsd``), for very many users."""
    e = with_event_time(events, delay=delay)
    w = F.window(EVENT_TIME, window, slide).alias("w")
    if approx:
        counted = e.groupBy(w).agg(F.approx_count_distinct("user_id", rsd).alias("active_users"))
    else:
        # An event is one row of a slot; only (slot, user) rows are copied to
        # the windows that hold the slot.
        per_slot = e.groupBy(F.window(EVENT_TIME, slide).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
        in_windows = F.window(F.window_time("s"), window, slide).alias("w")
        per_user = per_slot.groupBy(in_windows, "user_id").agg(F.sum("n").alias("n"))
        counted = per_user.groupBy("w").agg(F.count(F.lit(1)).alias("active_users"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "active_users")


def daily_purchases(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T3: purchases (rows) and revenue per calendar day; update mode."""
    e = with_event_time(events, delay=delay).filter(F.col("event_name") == "purchase")
    return (e.groupBy(F.window(EVENT_TIME, "1 day").alias("d"))
            .agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("revenue"))
            .select(F.to_date(F.col("d.start")).alias("day"), "orders", "revenue"))


def store_assignments(batch: DataFrame, table: str) -> None:
    """T4 for one micro-batch: the first assignment of each (user, run) that
    ``table`` does not hold, whenever it was stored.  Only the runs of the
    batch are looked up (the table is partitioned by run)."""
    runs = [r[0] for r in batch.select("run_id").distinct().collect()]      # one value per run of the batch
    known = stored(batch.sparkSession, table).where(
        F.col("run_id").isin([r for r in runs if r is not None]) | F.col("run_id").isNull())
    insert_by_name(assign_new(batch, known), table)


def start_assign_once(assignments: DataFrame, table: str, checkpoint: str, trigger: dict | None = None):
    """T4: store each user's first assignment of a run, once."""
    return _start(assignments, checkpoint, lambda b, _: store_assignments(b, table), trigger)


def live_visitors(spark: SparkSession, table: str) -> DataFrame:
    """T5: distinct visitors per (run, variant) of the assignments that T4 has
    stored so far."""
    return variant_users(stored(spark, table))


def refresh_mart_batch(batch: DataFrame, events: str, assignments: str, table: str,
                       metrics=mart_ops.OPTIONAL_METRICS) -> None:
    """T6 for one micro-batch: the days the batch touches are rebuilt from the
    stored ``events`` and ``assignments`` (tables or folders, read as they
    are now) and replace those days' partitions, so replaying a batch gives
    the same table."""
    spark = batch.sparkSession
    ev, asg = stored(spark, events), stored(spark, assignments)
    if ev is None or asg is None:
        return
    # The touched days of one batch: bounded by the batch's time span.
    days = F.broadcast(batch.select(F.to_date("timestamp").alias("report_date"))
                       .filter(F.col("report_date").isNotNull()).distinct())
    if "event_date" in ev.columns:
        # Stored events are partitioned by date: the semi join lets dynamic
        # partition pruning read only the touched days.
        ev = ev.join(days, ev.event_date == days.report_date, "left_semi")
    else:
        ev = (ev.withColumn("report_date", F.to_date("timestamp"))
              .join(days, "report_date", "left_semi").drop("report_date"))
    asg = (asg.withColumn("report_date", F.to_date("assigned_at"))
           .join(days, "report_date", "left_semi").drop("report_date"))
    fresh = mart_ops.with_updated_at(mart_ops.build_mart(asg, ev, metrics))
    rows = staged(fresh)                # one row per touched day
    if not rows.isEmpty():
        overwrite_partitions(rows, table)


def start_mart_refresh(event_stream: DataFrame, events: str, assignments: str, table: str, checkpoint: str,
                       trigger: dict | None = None, metrics=mart_ops.OPTIONAL_METRICS):
    """T6: keep the KPI mart fresh from an event stream whose events something
    else stores."""
    return _start(event_stream, checkpoint, lambda b, _: refresh_mart_batch(b, events, assignments, table, metrics), trigger)


def start_live_mart(event_stream: DataFrame, events: str, assignments: str, table: str, checkpoint: str,
                    trigger: dict | None = None, metrics=mart_ops.OPTIONAL_METRICS, ledger: str | None = None):
    """T1, then T6, in the same micro-batch (T7): what a batch brings, late rows
    included, is stored before the days it touches are rebuilt.  ``folds.LiveMart`` does the same
    without reading those days' events again."""
    ids = ledger or default_ledger(event_stream.sparkSession, events)

    def both(batch, segment):
        store_events(batch, events, ids, segment)
        refresh_mart_batch(batch, events, assignments, table, metrics)

    return _start(event_stream, checkpoint, both, trigger)
