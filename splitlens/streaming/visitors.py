"""T5 as a stream: visitors per (run, variant), counted as assignments are stored.

Two chained stateful operators: the first sight of (run, variant, user), then the count
by variant, in update mode.  Each batch puts the counts that it changed into a segment of its own.
Counts of distinct users only grow, so the current one is the largest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitlens.streaming import segments

COUNTS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("variant", T.StringType()),
                       T.StructField("visitors", T.LongType())])


def visitor_counts(assignments: DataFrame) -> DataFrame:
    """(run_id, variant, visitors) of an assignment stream (or table), rows without a run aside."""
    seen = assignments.where(F.col("run_id").isNotNull()).dropDuplicates(["run_id", "variant", "user_id"])
    return seen.groupBy("run_id", "variant").agg(F.count("user_id").alias("visitors"))


def start_live_visitors(assignments: DataFrame, target: str, checkpoint: str, trigger: dict | None = None):
    """Keep ``target`` (a folder) current from a stream of stored assignments."""
    def put(batch: DataFrame, batch_id: int) -> None:
        segments.put(batch, target, segments.name_of(checkpoint, batch_id))

    w = visitor_counts(assignments).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    return (w.trigger(**trigger) if trigger else w).start()


def current_visitors(spark: SparkSession, target: str) -> DataFrame:
    """(run_id, variant, visitors) as of the last batch; no rows before the first."""
    rows = segments.read(spark, target, COUNTS)
    if rows is None:
        return spark.createDataFrame([], COUNTS)
    return rows.groupBy("run_id", "variant").agg(F.max("visitors").alias("visitors"))


def compact_visitors(spark: SparkSession, target: str) -> None:
    """Fold the segments of stopped or idle streams into one."""
    segments.compact(spark, target, COUNTS, lambda rows: rows.groupBy("run_id", "variant").agg(F.max("visitors").alias("visitors")))
