"""User journeys: events of a run in order, with neighbours and funnel stage.

A journey is a window over (run_id, user_id) ordered by (timestamp,
event_id).  A plain window sends each group to one task, so one bot or shared
id holding a large share of a run's events would be sorted and scanned by a
single task.  So groups are counted first (map-side folded): those of more than a
``SLICES``-th of all events, and of ``HOT_ROWS`` at least, are hot; there are fewer than ``SLICES``.
Without one, the plain window is the plan; the rows of hot groups get a prefix scan over ranges of
their order:

1. the order keys (timestamp, event id, hash of the row) of hot groups are
   sampled, and every ``PER_SLICE``-th of the sampled keys is a boundary, so that a group is cut
   where its events are, whatever their times;
2. a window inside (run, user, slice) numbers the rows and finds neighbours;
3. every slice is folded (map-side) to its carry facts: how many events, the
   first and the last; a window over a group's facts gives the events
   before the slice, the last event before it and the first after it;
4. assignments join the facts, not the events;
5. rows meet their slice's facts on (run, user, slice), the key they are
   already dealt out by, which corrects the rows at the slice's ends.

The sample is taken by a hash of the row, so a plan that runs again finds the same
boundaries, and its expected size (``SLICES`` x ``PER_SLICE`` keys) does not depend on the volume; at most
about ``SLICES`` boundaries are broadcast.  Which groups are hot, and how they are cut, never changes results.
Rows that agree in every column have no order among themselves and stay together.

``skew_safe=False`` gives the plain window (for data known to have no hot
groups).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed funnel stages of the modelled application (first match wins).
STAGE_AWARENESS = "Awareness"
STAGE_INTEREST = "Interest"
STAGE_CONVERSION = "Conversion"
STAGE_OTHER = "Other"

# Slices that all events would make, and sampled keys between two boundaries.
SLICES = 1000
PER_SLICE = 64
HOT_ROWS = 100_000

def funnel_stage(name: Column) -> Column:
    return (F.when(name.like("banner%"), F.lit(STAGE_AWARENESS))
            .when(name == "click_banner", F.lit(STAGE_INTEREST))
            .when(name == "purchase", F.lit(STAGE_CONVERSION))
            .otherwise(F.lit(STAGE_OTHER)))


def _joined(events: DataFrame, assignments: DataFrame, run_ids) -> DataFrame:
    e = events.filter(F.col("run_id").isNotNull())
    a = assignments.filter(F.col("run_id").isNotNull())
    if run_ids is not None:
        e = e.filter(F.col("run_id").isin(list(run_ids)))
        a = a.filter(F.col("run_id").isin(list(run_ids)))
    j = e.join(a.select("user_id", "run_id", "variant", "weight"), ["user_id", "run_id"], "left")
    return j.select("event_id", "user_id", "run_id", "variant", "event_name", "timestamp", "value", "weight")


def _finish(df: DataFrame, seq, prev_event, prev_ts, next_event) -> DataFrame:
    return df.select(
        "event_id", "user_id", "run_id", "variant", "event_name", "timestamp", "value", "weight",
        seq.cast("int").alias("event_sequence"), prev_event.alias("prev_event"), next_event.alias("next_event"),
        (F.unix_timestamp("timestamp") - F.unix_timestamp(prev_ts)).alias("time_since_last_event"),
        funnel_stage(F.col("event_name")).alias("funnel_stage"))


def _window_journey(j: DataFrame) -> DataFrame:
    w = Window.partitionBy("run_id", "user_id").orderBy("timestamp", "event_id", "variant", "weight")
    return _finish(j, F.row_number().over(w), F.lag("event_name").over(w), F.lag("timestamp").over(w),
                   F.lead("event_name").over(w))


def _position(bounds: Column, key: Column, most: int) -> Column:
    """How many of the sorted ``bounds`` (fewer than 2 ** ``most``) are at or below ``key``: a binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(most - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.try_element_at(bounds, at + step) <= key, at + step).otherwise(at))
    return F.when(bounds.isNull(), F.lit(0)).otherwise(F.coalesce(found, F.lit(0)))


def hot_groups(events: DataFrame, slices: int = SLICES, hot_rows: int = HOT_ROWS) -> list:
    """(run_id, _user, all events) of the groups that need cutting: fewer than ``slices``
    rows by construction."""
    sizes = events.groupBy("run_id", "_user").agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.count(F.lit(1)).alias("of"))
    return (sizes.where(F.col("n") >= hot_rows).crossJoin(F.broadcast(total))      # one row
            .where(F.col("n") * slices > F.col("of")).select("run_id", "_user", "of").collect())


def with_slices(events: DataFrame, hot: DataFrame, slices: int = SLICES, per_slice: int = PER_SLICE) -> DataFrame:
    """The ``events`` (with ``_user``) of the ``hot`` groups with ``_slice``, the range of the
    order key that a row is in."""
    keys = ["run_id", "_user"]
    # Structs compare field by field, NULL first, as the window orders them.
    key = F.struct(F.col("timestamp"), F.col("event_id"), F.xxhash64(*events.columns).alias("h"))
    rows = events.join(F.broadcast(hot), keys)
    every = F.greatest(F.lit(1), F.floor(F.col("of") / (slices * per_slice)))
    sample = rows.where(F.pmod(F.xxhash64(F.lit(1), *events.columns), every) == 0)
    bounds = (sample.groupBy(*keys).agg(F.array_sort(F.collect_list(key)).alias("_all"))
              .select(*keys, F.filter("_all", lambda _, i: i % per_slice == per_slice - 1).alias("_bounds")))
    return (rows.drop("of").join(F.broadcast(bounds), keys, "left")
            .withColumn("_slice", _position(F.col("_bounds"), key, (4 * slices).bit_length()).cast("long")).drop("_bounds"))


def _sliced_journey(events: DataFrame, hot: DataFrame, assignments: DataFrame, slices: int, per_slice: int) -> DataFrame:
    e = with_slices(events, hot, slices, per_slice)
    keys = ["run_id", "_user", "_slice"]
    w = Window.partitionBy(*keys).orderBy("timestamp", "event_id")
    local = e.withColumns({
        "_n": F.row_number().over(w), "_prev": F.lag("event_name").over(w), "_prev_ts": F.lag("timestamp").over(w),
        "_is_last": F.lead("_slice").over(w).isNull(), "_next": F.lead("event_name").over(w)})

    order = F.struct("timestamp", "event_id")
    row = F.struct("event_name", "timestamp")
    facts = e.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"), F.min_by(row, order).alias("_first"),
                                  F.max_by(row, order).alias("_last"))
    s = Window.partitionBy("run_id", "_user").orderBy("_slice")
    facts = facts.withColumns({
        "_before": F.coalesce(F.sum("_count").over(s.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_from": F.lag("_last").over(s), "_to": F.lead("_first").over(s)})
    # Several assignments of a user in a run give each event once per assignment, k of m.
    of_user = Window.partitionBy("run_id", "user_id")
    a = (assignments.filter(F.col("run_id").isNotNull() & F.col("user_id").isNotNull())
         .select(F.col("run_id"), "user_id", F.concat(F.lit("u"), F.col("user_id")).alias("_user"), "variant", "weight")
         .withColumns({"_k": F.row_number().over(of_user.orderBy("variant", "weight")),
                       "_m": F.count(F.lit(1)).over(of_user)}).drop("user_id"))
    facts = facts.join(a, ["run_id", "_user"], "left").fillna(1, ["_k", "_m"])

    j = local.join(facts, keys)
    copy, last_copy = F.col("_k") > 1, F.col("_k") == F.col("_m")
    first_of_slice = F.col("_n") == 1
    prev = (F.when(copy, F.col("event_name")).when(first_of_slice, F.col("_from.event_name")).otherwise(F.col("_prev")))
    prev_ts = (F.when(copy, F.col("timestamp")).when(first_of_slice, F.col("_from.timestamp")).otherwise(F.col("_prev_ts")))
    following = (F.when(~last_copy, F.col("event_name")).when(F.col("_is_last"), F.col("_to.event_name")).otherwise(F.col("_next")))
    seq = (F.col("_before") + F.col("_n") - 1) * F.col("_m") + F.col("_k")
    return _finish(j, seq, prev, prev_ts, following)


def user_journey(events: DataFrame, assignments: DataFrame, run_ids=None, skew_safe: bool = True,
                 slices: int = SLICES, per_slice: int = PER_SLICE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every event of every run with its user's variant and weight, its
    position in the user's sequence (ties by event id), previous and next
    event name, seconds since the previous event, and funnel stage.  A user
    assigned several times in a run has each event once per assignment."""
    e = events.filter(F.col("run_id").isNotNull())
    if run_ids is not None:
        e = e.filter(F.col("run_id").isin(list(run_ids)))
    if not skew_safe:
        return _window_journey(_joined(e, assignments, run_ids))
    # Keys without NULLs, so that plain equality joins them; events without a time come first.
    user = F.coalesce(F.concat(F.lit("u"), F.col("user_id")), F.lit("")).alias("_user")
    e = e.select("event_id", "user_id", "run_id", "event_name", "timestamp", "value", user)
    found = hot_groups(e, slices, hot_rows)
    if not found:
        return _window_journey(_joined(e, assignments, run_ids))
    hot = e.sparkSession.createDataFrame(found, "run_id string, _user string, of long")
    rest = e.join(F.broadcast(hot), ["run_id", "_user"], "left_anti")
    return _window_journey(_joined(rest, assignments, run_ids)).unionByName(_sliced_journey(e, hot, assignments, slices, per_slice))


def write_journey_csv(journey: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header (one file per partition; no driver collect)."""
    (journey.orderBy("run_id", "user_id", "event_sequence")
     .write.mode(mode).option("header", True).csv(path))
