"""T6 incrementally: the KPI mart from stored per-user folds.

A fold is one row per (day, user): assignments, whether the user clicked or bought, revenue, events --
all mergeable, by sum or max.  Each batch folds what it brought and puts that into a
segment of its own; the days it touched are then derived from those days' folds alone.
Stored events are never read again.

Events and assignments come in one stream (``both``), so that one query alone replaces mart days.
A batch first writes down what is new in it (``segments.once``): run again, it
stores, folds and derives the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitlens.operators import mart as mart_ops
from splitlens.operators.assignment import NULL_RUN, assign_once
from splitlens.sources.schemas import ASSIGNMENTS, EVENTS
from splitlens.sources.sinks import insert_by_name, overwrite_partitions, staged, table_schema
from splitlens.streaming import segments
from splitlens.streaming.ledger import Ledger, store_once
from splitlens.streaming.segments import stored

FOLD = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("n_assign", T.LongType()), T.StructField("clicked", T.IntegerType()),
    T.StructField("purchased", T.IntegerType()), T.StructField("revenue", T.DoubleType()), T.StructField("n_events", T.LongType()),
    T.StructField("report_date", T.DateType())])


def both(events: DataFrame, assignments: DataFrame) -> DataFrame:
    """One stream (or frame) of events and assignments, told apart by the column ``event``."""
    return events.withColumn("event", F.lit(True)).unionByName(assignments.withColumn("event", F.lit(False)), allowMissingColumns=True)


def merged(folds: DataFrame) -> DataFrame:
    """One row per (day, user) of fold rows."""
    return folds.groupBy("report_date", "user_id").agg(
        F.sum("n_assign").alias("n_assign"), F.max("clicked").alias("clicked"), F.max("purchased").alias("purchased"),
        F.sum("revenue").alias("revenue"), F.sum("n_events").alias("n_events"))


def fold(events: DataFrame, assignments: DataFrame) -> DataFrame:
    """Folds of some events and assignments."""
    e = mart_ops._event_fold(events.withColumn("report_date", F.to_date("timestamp")), ["user_id", "report_date"])
    a = mart_ops._assignment_fold(assignments)
    return merged(e.withColumn("n_assign", F.lit(0).cast("long")).unionByName(a, allowMissingColumns=True)).select(*FOLD.names)


def _first(requests: DataFrame, known: DataFrame) -> DataFrame:
    """``assign_once`` with a missing user as a user, so that a batch that runs again finds those rows too."""
    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("user_id", F.coalesce("user_id", F.lit(NULL_RUN)))

    return assign_once(named(requests), named(known)).withColumn("user_id", F.nullif("user_id", F.lit(NULL_RUN)))


def mart_of(folds: DataFrame, metrics=mart_ops.OPTIONAL_METRICS) -> DataFrame:
    """The KPI mart of fold rows; a user without an assignment on the day does not count."""
    return mart_ops.finish_mart(merged(folds).where("n_assign > 0"), metrics)


class LiveMart:
    """Stores events and assignments once and keeps folds and mart current.

    ``events``, ``assignments``, ``table``: catalogue tables (or folders, for the first); ``folder`` holds ledger, folds and
    what batches found new.  ``seed`` enters tables that were filled by other means."""

    def __init__(self, spark: SparkSession, events: str, assignments: str, table: str, folder: str,
                 metrics=mart_ops.OPTIONAL_METRICS, **ledger):
        self.spark, self.events, self.assignments, self.table, self.metrics = spark, events, assignments, table, metrics
        self.folder = folder.rstrip("/")
        self.ledger = Ledger(spark, f"{self.folder}/ledger", **ledger)

    def folds(self) -> DataFrame | None:
        return segments.read(self.spark, f"{self.folder}/folds", FOLD)

    def seed(self) -> None:
        """Ledger and folds of what the tables hold already."""
        ev, asg = stored(self.spark, self.events, table_schema("events")), stored(self.spark, self.assignments)
        if ev is not None:
            self.ledger.add(ev.select("event_id"), "seed")
        ev = ev if ev is not None else self.spark.createDataFrame([], EVENTS)
        segments.put(fold(ev, asg), f"{self.folder}/folds", "seed", ["report_date"])

    def _new_assignments(self, batch: DataFrame, segment: str) -> DataFrame:
        rows = batch.where("NOT event").select(*ASSIGNMENTS.names)
        known = stored(self.spark, self.assignments)
        runs = F.broadcast(rows.select(F.col("run_id").alias("_run")).distinct())       # the runs of a batch
        known = known.join(runs, F.col("run_id").eqNullSafe(F.col("_run")), "left_semi")
        new, again = segments.once(_first(rows, known), f"{self.folder}/new-assignments", segment)
        insert_by_name(_first(new, known) if again else new, self.assignments)
        return new

    def process(self, batch: DataFrame, segment: str) -> None:
        """One batch of ``both``: store, fold, derive the days that it touched."""
        events = store_once(batch.where("event"), self.events, self.ledger, segment)
        assignments = self._new_assignments(batch, segment)
        segments.put(fold(events, assignments), f"{self.folder}/folds", segment, ["report_date"])
        self.refresh(self.folds().where(F.col("segment") == segment).select("report_date"))

    def of_days(self, days: DataFrame) -> DataFrame:
        """The fold rows of ``days`` (report_date); only their partitions are opened."""
        # One value per calendar day that a batch touches.
        listed = [r[0] for r in days.where("report_date IS NOT NULL").distinct().collect()]
        return self.folds().where(F.col("report_date").isin(listed))

    def refresh(self, days: DataFrame) -> None:
        """Derive the mart of ``days`` (report_date) from their folds."""
        rows = staged(mart_ops.with_updated_at(mart_of(self.of_days(days), self.metrics)))
        if not rows.isEmpty():
            overwrite_partitions(rows, self.table)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Run on a stream of ``both``."""
        def run(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                self.process(batch, segments.name_of(checkpoint, batch_id))
            finally:
                batch.unpersist()

        w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
        return (w.trigger(**trigger) if trigger else w).start()

    def compact(self) -> None:
        """Fold the segments into one per day, and the ledger's into one."""
        segments.compact(self.spark, f"{self.folder}/folds", FOLD, lambda f: merged(f).select(*FOLD.names), ["report_date"])
        self.ledger.compact()
