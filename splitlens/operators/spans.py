"""Distinct users over any span of days, from stored daily rows.

``COUNT(DISTINCT)`` of a week cannot be added up from days, so every span was
recounted from events.  Two kinds of daily rows can be merged instead:

* bitmaps over numbered users -- exact: one 4 KB bitmap per (day, group, block of
  32,768 users); a span is their union, an overlap of two spans follows from three unions;
* HyperLogLog sketches -- one per (day, group), whatever the users; relative standard error about
  ``1.04 / sqrt(2 ** lg_k)``, 1.6 % by default.

Rows without a user do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.sources.sinks import staged

LG_K = 12


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, n) of the distinct ``users``: numbers that are dense within each partition, so that
    few bitmap blocks are needed.  Written once, as the numbers must not change;
    users of ``known`` (an earlier result) keep theirs."""
    new = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    if known is None:
        return staged(new.withColumn("n", F.monotonically_increasing_id()))
    # One number: the first block that no known user is in.
    start = known.agg(F.coalesce((F.floor(F.max("n") / 32768) + 1) * 32768, F.lit(0)).cast("long")).first()[0]
    new = new.join(known, "user_id", "left_anti").withColumn("n", F.monotonically_increasing_id() + F.lit(start))
    return staged(known.select("user_id", "n").unionByName(new))


def daily_bitmaps(facts: DataFrame, numbers: DataFrame, day: Column, *by: str) -> DataFrame:
    """(day, ``by``, block, bitmap): the users of each day and group."""
    numbered = facts.where(F.col("user_id").isNotNull()).select(day.alias("day"), *by, "user_id").distinct().join(numbers, "user_id")
    return numbered.groupBy("day", *by, F.bitmap_bucket_number("n").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bitmap"))


def span_users(bitmaps: DataFrame, span: Column, *by: str, name: str = "users") -> DataFrame:
    """(span, ``by``, users): exact distinct users per span, e.g. the week of ``day``."""
    merged = bitmaps.groupBy(span.alias("span"), *by, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("span", *by).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))


def span_overlap(bitmaps: DataFrame, span: Column, following: Column, *by: str) -> DataFrame:
    """(span, ``by``, users, kept): ``users`` of a span and how many of them are there in the
    next one as well, by |A| + |B| - |A or B|.  ``following`` is the span that a span's next one would call its
    previous, e.g. the week before that of ``day``."""
    size = span_users(bitmaps, span, *by)
    after = span_users(bitmaps, following, *by, name="after")
    # Each day's bitmap belongs to the union of its own span and to that of the span before.
    spans = F.explode(F.array(span, following)).alias("span")
    either = bitmaps.select(spans, *by, "block", "bitmap").groupBy("span", *by, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    either = either.groupBy("span", *by).agg(F.sum(F.bitmap_count("bitmap")).alias("either"))
    joined = size.join(either, ["span", *by]).join(after, ["span", *by], "left")
    return joined.select("span", *by, "users", (F.col("users") + F.coalesce("after", F.lit(0)) - F.col("either")).cast("long").alias("kept"))


def daily_sketches(facts: DataFrame, day: Column, *by: str, lg_k: int = LG_K) -> DataFrame:
    """(day, ``by``, sketch): a HyperLogLog sketch of each day's users."""
    return facts.groupBy(day.alias("day"), *by).agg(F.hll_sketch_agg("user_id", F.lit(lg_k)).alias("sketch"))


def span_users_approx(sketches: DataFrame, span: Column, *by: str) -> DataFrame:
    """(span, ``by``, users): estimates from the merged sketches."""
    return sketches.groupBy(span.alias("span"), *by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


def week_of(day: str = "day") -> Column:
    """The Monday of a day's week."""
    return F.to_date(F.date_trunc("week", F.col(day)))
