"""The sliced (skew-safe) journey equals the plain window at every number of
slices, for hot groups, ties, missing times and repeated assignments."""

import datetime as dt

from pyspark.sql import functions as F

from splitlens.operators import journey
from splitlens.sources.schemas import EVENTS
from tests.conftest import frame

T = dt.datetime
COLS = ["event_id", "user_id", "run_id", "variant", "event_name", "timestamp", "value", "weight", "event_sequence",
        "prev_event", "next_event", "time_since_last_event", "funnel_stage"]


def as_set(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def test_split_equals_window_on_fixture(spark, fx):
    a = journey.user_journey(fx.events, fx.assignments, skew_safe=False)
    b = journey.user_journey(fx.events, fx.assignments, slices=50, per_slice=4, hot_rows=2)
    assert as_set(a) == as_set(b)


def test_split_with_hot_group(spark):
    names = ["banner_A", "click_banner", "purchase", "page_view", "bounce"]
    rows = []
    # One hot user with 3,000 events (ties on the second), plus small groups around it.
    for i in range(3000):
        rows.append(dict(event_id=f"h{i:05d}", user_id="hot", event_name=names[i % 5],
                         timestamp=T(2024, 1, 1) + dt.timedelta(seconds=i // 3), value=float(i), run_id="r1"))
    for u in range(40):
        for i in range(u % 4 + 1):
            rows.append(dict(event_id=f"s{u}-{i}", user_id=f"u{u:02d}", event_name=names[(u + i) % 5],
                             timestamp=T(2024, 1, 1, 1) + dt.timedelta(minutes=i), run_id="r1" if u % 2 else "r2"))
    e = frame(spark, EVENTS, rows)
    a = spark.createDataFrame([("hot", "r1", "B", 2.0), ("u01", "r1", "A", 1.0), ("u01", "r1", "B", 1.5), ("u03", "r1", "A", 1.0),
                               ("u03", "r1", "A", 1.0), (None, "r1", "A", 1.0), ("u05", None, "A", 1.0)],
                              "user_id string, run_id string, variant string, weight double")
    want = journey.user_journey(e, a, skew_safe=False)
    for slices, per_slice in ((3, 1), (40, 8), (1000, 64)):
        assert as_set(journey.user_journey(e, a, slices=slices, per_slice=per_slice, hot_rows=2)) == as_set(want)
    hot = journey.user_journey(e, a, slices=40, hot_rows=100).filter(F.col("user_id") == "hot")
    assert hot.agg(F.max("event_sequence")).collect()[0][0] == 3000


def test_hot_user_is_cut_evenly(spark):
    """One user holds nine tenths of 200,000 events, half of them in the same second: no task
    gets much more than the median, and the numbering is whole."""
    n = 200_000
    e = spark.range(n).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("u"), (F.col("id") / 10 % 5000).cast("int"))).otherwise(F.lit("hot")).alias("user_id"),
        F.lit("page_view").alias("event_name"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 977))).alias("timestamp"),
        F.lit(1.0).alias("value"), F.lit("r1").alias("run_id"))
    keyed = e.withColumn("_user", F.concat(F.lit("u"), "user_id"))
    found = journey.hot_groups(keyed, slices=100)
    assert [tuple(r) for r in found] == [("r1", "uhot", n)]
    cut = journey.with_slices(keyed, spark.createDataFrame(found), slices=100)
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert len(sizes) > 60 and max(sizes) < 3 * n / 100
    tasks = (cut.repartition(8, "run_id", "_user", "_slice").groupBy(F.spark_partition_id().alias("p")).count()
             .orderBy("count").collect())
    assert tasks[-1]["count"] < 1.6 * tasks[4]["count"]
    a = spark.createDataFrame([("hot", "r1", "B", 2.0)], "user_id string, run_id string, variant string, weight double")
    got = journey.user_journey(e, a, slices=100).where("user_id = 'hot'").agg(
        F.count("*"), F.count_distinct("event_sequence"), F.max("event_sequence"), F.count("prev_event")).first()
    assert tuple(got) == (n * 9 // 10, n * 9 // 10, n * 9 // 10, n * 9 // 10 - 1)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ev = st.fixed_dictionaries(dict(
    user_id=st.sampled_from(["a", "b", "c", None]), run_id=st.sampled_from(["r1", "r2"]),
    event_name=st.sampled_from(["banner_A", "click_banner", "purchase", "x"]),
    timestamp=st.one_of(st.none(), st.integers(0, 40).map(lambda s: T(2024, 1, 1) + dt.timedelta(seconds=s)))))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ev, min_size=1, max_size=80), st.integers(2, 30), st.integers(1, 3))
def test_split_equals_window_on_random_rows(spark, rows, slices, per_slice):
    e = frame(spark, EVENTS, [dict(r, event_id=f"e{i:03d}") for i, r in enumerate(rows)])
    a = spark.createDataFrame([("a", "r1", "A", 1.0), ("a", "r1", "B", 1.0), ("b", "r2", "B", 2.0)],
                              "user_id string, run_id string, variant string, weight double")
    want = journey.user_journey(e, a, skew_safe=False)
    assert as_set(journey.user_journey(e, a, slices=slices, per_slice=per_slice, hot_rows=2)) == as_set(want)
