"""Ids seen so far, for all time: a ledger in hash buckets with a Bloom filter each.

``<folder>/ids`` holds the ids by segment and bucket, ``<folder>/bits`` the filters' bits as 32,768-bit
blocks (``bitmap_construct_agg``).  A batch probes the blocks its ids fall in; only
buckets in which an id has both of its bits set are opened for the exact comparison.  A
full filter opens more buckets, never fewer, so the answer is exact at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitlens.sources.schemas import EVENTS, PARTITIONING
from splitlens.sources.sinks import insert_by_name, staged, table_schema
from splitlens.streaming import segments
from splitlens.streaming.segments import stored

BUCKETS = 256
# Bits of a bucket's filter: 1 MB, good for some 400,000 ids each, 10^8 in all; raise it with the ids expected.
BITS = 1 << 23

IDS = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("bucket", T.IntegerType())])
BLOCKS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("block", T.LongType()),
                       T.StructField("bitmap", T.BinaryType())])


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), bit % 8)) % 2 == 1


class Ledger:
    """The ledger in ``folder``; ``buckets`` and ``bits`` must stay as they were at the first segment."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, bits: int = BITS):
        self.spark, self.folder, self.buckets, self.bits = spark, folder.rstrip("/"), buckets, bits
        self.opened: list[int] = []

    def _keyed(self, ids: DataFrame) -> DataFrame:
        return ids.select("event_id", F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int").alias("bucket"))

    def _probes(self, keyed: DataFrame) -> DataFrame:
        places = [F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(self.bits)) for seed in (1, 2)]
        return (keyed.withColumn("place", F.explode(F.array(*places)))
                .withColumns({"block": F.floor(F.col("place") / 32768), "bit": F.col("place") % 32768}))

    def may_hold(self, ids: DataFrame, but: str | None = None) -> list[int]:
        """The buckets that may hold some of ``ids`` (segment ``but`` aside): one number each."""
        blocks = segments.read(self.spark, f"{self.folder}/bits", BLOCKS)
        if blocks is None:
            return []
        blocks = blocks.where(F.col("segment") != F.lit(but or ""))
        probes = self._probes(self._keyed(ids))
        needed = probes.select("bucket", "block").distinct()
        merged = blocks.join(needed, ["bucket", "block"], "left_semi").groupBy("bucket", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        hits = probes.join(merged, ["bucket", "block"]).where(_is_set(F.col("bitmap"), F.col("bit")))
        # An id whose two places agree has one probe hit twice.
        maybe = hits.groupBy("event_id", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n = 2")
        return sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())

    def unseen(self, ids: DataFrame, but: str | None = None) -> DataFrame:
        """The rows of ``ids`` (event_id, ...) that no segment but ``but`` holds."""
        self.opened = self.may_hold(ids, but)
        if not self.opened:
            return ids
        known = segments.read(self.spark, f"{self.folder}/ids", IDS)
        known = known.where(F.col("bucket").isin(self.opened) & (F.col("segment") != F.lit(but or "")))
        return ids.join(known.select("event_id"), "event_id", "left_anti")

    def add(self, ids: DataFrame, segment: str) -> None:
        """Enter ``ids`` as ``segment``; its bits first, so that a ledger half written has none too few."""
        keyed = self._keyed(ids)
        blocks = (self._probes(keyed).groupBy("bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap")))
        segments.put(blocks, f"{self.folder}/bits", segment)
        segments.put(keyed.repartition("bucket"), f"{self.folder}/ids", segment, ["bucket"])

    def is_empty(self) -> bool:
        return segments.read(self.spark, f"{self.folder}/ids", IDS) is None

    def compact(self) -> None:
        segments.compact(self.spark, f"{self.folder}/bits", BLOCKS,
                         lambda b: b.groupBy("bucket", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))
        segments.compact(self.spark, f"{self.folder}/ids", IDS, lambda i: i.distinct().repartition("bucket"), ["bucket"])


def one_per_id(events: DataFrame) -> DataFrame:
    """Of each event id the earliest row, then the least, so that the choice is the same whenever a
    batch runs.  An event without an id gets one from its content."""
    rest = [c for c in events.columns if c != "event_id"]
    own = F.concat(F.lit("auto-"), F.xxhash64(*rest).cast("string"))
    order = ["timestamp", *[c for c in rest if c != "timestamp"]]
    return (events.withColumn("event_id", F.coalesce("event_id", own)).groupBy("event_id")
            .agg(F.min(F.struct(*order)).alias("r")).select("event_id", *[F.col(f"r.{c}").alias(c) for c in rest]))


def append_unstored(rows: DataFrame, target: str, spark: SparkSession, look_up: bool = True) -> None:
    """Append ``rows`` (with ``event_date``) to the table or folder ``target``; with ``look_up``
    without those whose ids it holds on the same dates."""
    known = stored(spark, target, table_schema("events")) if look_up else None
    if known is not None:
        # At most one value per calendar day of the batch.
        dates = [r[0] for r in rows.select("event_date").distinct().collect()]
        on_days = F.col("event_date").isin([d for d in dates if d is not None])
        if None in dates:
            on_days = F.coalesce(on_days, F.lit(False)) | F.col("event_date").isNull()
        rows = rows.join(known.where(on_days).select("event_id"), "event_id", "left_anti")
    if "/" in target:
        rows.write.mode("append").partitionBy(*PARTITIONING["events"]).parquet(target)
    else:
        insert_by_name(rows, target)


def store_once(batch: DataFrame, target: str, ledger: Ledger, segment: str) -> DataFrame:
    """Store the events of ``batch`` whose ids ``ledger`` does not know, and enter them; returns
    them as the batch first found them, however often it runs."""
    rows = staged(one_per_id(batch.select(*EVENTS.names)))
    new, again = segments.once(ledger.unseen(rows, segment), f"{ledger.folder}/new", segment)
    ledger.add(new.select("event_id"), segment)
    # Only a batch that runs again may have stored some of them.
    append_unstored(new.withColumn("event_date", F.to_date("timestamp")), target, batch.sparkSession, look_up=again)
    return new
