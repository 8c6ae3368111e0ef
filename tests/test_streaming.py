"""Streams equal batch: T1-T7 over the sf0.01 fixtures split into files."""

import datetime as dt
import pytest
from pyspark.sql import functions as F

from splitlens.operators import mart
from splitlens.sources import schemas, sinks
from splitlens.sources.fixtures import Fixtures
from splitlens.streaming import jobs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    fx = Fixtures(spark, SF)
    root = tmp_path_factory.mktemp("streams")
    ev = fx.events
    # Files in time order (one per 5 days), plus exact re-sends of 40 events.
    ev.withColumn("_k", F.floor(F.dayofmonth("timestamp") / 5)).repartition(6, "_k").sortWithinPartitions(
        "timestamp").drop("_k").write.parquet(str(root / "events" / "part1"))
    ev.orderBy("event_id").limit(40).write.parquet(str(root / "events" / "part2"))
    fx.assignments.write.parquet(str(root / "assignments"))
    return fx, str(root)


def run_memory(df, name, mode, ckpt):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def finish(q):
    q.processAllAvailable()
    q.stop()


def test_t1_stores_every_event_once(spark, data, tmp_path):
    """Files in time order, exact re-sends, then rows hours and weeks late, a
    second time too; at last all again under a new checkpoint."""
    fx, root = data
    src, out = str(tmp_path / "src"), str(tmp_path / "ingested")
    held_back = fx.events.where("event_id % 97 = 0")
    spark.read.parquet(root + "/events/part1").join(held_back, "event_id", "left_anti").select(*fx.events.columns).write.parquet(src)
    q = jobs.start_ingest(jobs.read_stream(spark, src, schemas.EVENTS, max_files_per_trigger=2), out, str(tmp_path / "ck"))
    q.processAllAvailable()
    spark.read.parquet(root + "/events/part2").write.mode("append").parquet(src)
    held_back.write.mode("append").parquet(src)
    q.processAllAvailable()
    held_back.write.mode("append").parquet(src)
    finish(q)
    finish(jobs.start_ingest(jobs.read_stream(spark, src, schemas.EVENTS), out, str(tmp_path / "ck2")))
    got = spark.read.schema(sinks.table_schema("events")).parquet(out)
    assert got.count() == fx.events.count() == got.select("event_id").distinct().count()
    assert got.select(*fx.events.columns).exceptAll(fx.events).isEmpty()


def test_t1_rows_without_time_or_id(spark, tmp_path):
    from tests.conftest import frame
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = [dict(event_id="1", user_id="u"), dict(event_id=None, user_id="u", timestamp=dt.datetime(2024, 1, 1), run_id="r"),
            dict(event_id=None, user_id="v", timestamp=dt.datetime(2024, 1, 1), run_id="r")]
    for _ in range(2):
        frame(spark, schemas.EVENTS, rows).write.mode("append").parquet(src)
        finish(jobs.start_ingest(jobs.read_stream(spark, src, schemas.EVENTS), out, str(tmp_path / "ck")))
    got = spark.read.schema(sinks.table_schema("events")).parquet(out).collect()
    assert len(got) == 3 and all(r.event_id for r in got)


def test_t2_active_users_equals_batch(spark, data, tmp_path):
    fx, root = data
    src = str(tmp_path / "src")
    spark.read.parquet(root + "/events/part1").write.parquet(src)
    s = jobs.read_stream(spark, src, schemas.EVENTS, max_files_per_trigger=1)
    q = (jobs.active_users(s).writeStream.format("memory").queryName("t2").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    held = spark.table("t2").count()
    # One later event moves the watermark past every window of the data.
    flush = fx.events.limit(1).withColumn("timestamp", F.lit(dt.datetime(2024, 3, 1))).withColumn(
        "event_id", F.lit("flush"))
    flush.write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    got = spark.table("t2").filter(F.col("window_start") < F.lit(dt.datetime(2024, 2, 1)))
    w = F.window(F.col("timestamp").cast("timestamp"), "30 minutes", "5 minutes")
    batch = (fx.events.groupBy(w.alias("w")).agg(F.count_distinct("user_id").alias("b"))
             .select(F.col("w.start").alias("window_start"), "b"))
    assert held < batch.count() == got.count()       # append mode held the newest windows back
    j = got.join(batch, "window_start", "left")
    assert j.filter(F.col("b").isNull() | (F.col("b") != F.col("active_users"))).count() == 0


def test_t2_approx_within_tolerance(spark, data, tmp_path):
    fx, root = data
    s = jobs.read_stream(spark, root + "/events/part1", schemas.EVENTS, max_files_per_trigger=3)
    got = run_memory(jobs.active_users(s, approx=True, rsd=0.02), "t2a", "append", str(tmp_path / "ck"))
    w = F.window(F.col("timestamp").cast("timestamp"), "30 minutes", "5 minutes")
    batch = (fx.events.groupBy(w.alias("w")).agg(F.count_distinct("user_id").alias("b"))
             .select(F.col("w.start").alias("window_start"), "b"))
    j = got.join(batch, "window_start")
    assert j.count() == got.count() > 0
    assert j.filter(F.abs(F.col("active_users") - F.col("b")) > F.greatest(F.lit(1.0), F.col("b") * 0.1)).count() == 0


def test_t3_daily_purchases(spark, data, tmp_path):
    fx, root = data
    s = jobs.read_stream(spark, root + "/events/part1", schemas.EVENTS, max_files_per_trigger=2)
    got = run_memory(jobs.daily_purchases(s), "t3", "complete", str(tmp_path / "ck"))
    batch = (fx.events.filter("event_name = 'purchase'").groupBy(F.to_date("timestamp").alias("day"))
             .agg(F.count(F.lit(1)).alias("o"), F.sum("value").alias("r")))
    j = got.join(batch, "day")
    assert j.count() == batch.count() == got.count()
    assert j.filter((F.col("o") != F.col("orders")) | (F.abs(F.col("r") - F.col("revenue")) > 1e-6)).count() == 0


def test_t4_t5_assign_once_and_visitors(spark, data, tmp_path):
    fx, root = data
    db = "stream_assign"
    sinks.create_tables(spark, db, reset=True)
    table, src = f"{db}.assignments", str(tmp_path / "src")
    spark.read.parquet(root + "/assignments").write.parquet(src)
    q = jobs.start_assign_once(jobs.read_stream(spark, src, schemas.ASSIGNMENTS, max_files_per_trigger=1), table, str(tmp_path / "ck"))
    q.processAllAvailable()
    # The same users again in the same batch, days and months later.
    for days in (0, 3, 200):
        (fx.assignments.withColumn("assigned_at", F.col("assigned_at") + F.expr(f"INTERVAL {days} DAYS"))
         .write.mode("append").parquet(src))
        q.processAllAvailable()
    q.stop()
    stored = spark.table(table)
    assert stored.count() == fx.assignments.count()
    first = fx.assignments.groupBy("user_id", "run_id").agg(F.min("assigned_at").alias("t"))
    assert stored.join(first, ["user_id", "run_id"]).where("assigned_at <> t").isEmpty()
    got = {(r.run_id, r.variant): r.visitors for r in jobs.live_visitors(spark, table).collect()}
    batch = fx.assignments.groupBy("run_id", "variant").agg(F.count_distinct("user_id").alias("b"))
    assert got == {(r.run_id, r.variant): r.b for r in batch.collect()}


def test_t5_counts_a_returning_visitor_once(spark, tmp_path):
    from tests.conftest import frame
    db = "stream_return"
    sinks.create_tables(spark, db, reset=True)
    src = str(tmp_path / "src")
    for day in (1, 2, 9):
        frame(spark, schemas.ASSIGNMENTS, [dict(user_id="u", run_id=r, variant="A", weight=1.0, assigned_at=dt.datetime(2024, 1, day))
                                           for r in ("r", None)]).write.mode("append").parquet(src)
        finish(jobs.start_assign_once(jobs.read_stream(spark, src, schemas.ASSIGNMENTS), f"{db}.assignments", str(tmp_path / "ck")))
    assert [tuple(r) for r in jobs.live_visitors(spark, f"{db}.assignments").collect()] == [("r", "A", 1)]
    assert spark.table(f"{db}.assignments").count() == 2        # one with a run, one without


def mart_rows(df):
    return sorted((r.report_date, r.total_users, r.click_count, r.total_orders, round(r.total_revenue, 6)) for r in df.collect())


def test_t6_t7_live_mart_late_rows_and_replay(spark, data, tmp_path):
    """T1 and T6 in one batch, over files that arrive after the start: the mart
    equals the batch build of everything sent, late rows included; a replay
    of all batches and days that no batch touches leave it as it is."""
    fx, root = data
    db = "stream_mart"
    sinks.create_tables(spark, db, reset=True)
    table, src = f"{db}.dm_daily_kpi", str(tmp_path / "src")
    sinks.bulk_append(fx.assignments, f"{db}.assignments")
    untouched = spark.createDataFrame([(dt.date(2020, 1, 1), 7)], "report_date date, total_users long")
    sinks.insert_by_name(untouched, table)
    fx.events.where("timestamp < '2024-01-20'").write.parquet(src)

    def start(name):
        return jobs.start_live_mart(jobs.read_stream(spark, src, schemas.EVENTS, max_files_per_trigger=2), f"{db}.events",
                                    f"{db}.assignments", table, str(tmp_path / name))

    q = start("ck")
    q.processAllAvailable()
    fx.events.where("timestamp >= '2024-01-20'").write.mode("append").parquet(src)
    q.processAllAvailable()
    late = (fx.events.filter("timestamp < '2024-01-03' AND timestamp >= '2024-01-02'").limit(1)
            .withColumn("event_id", F.lit("late-1")).withColumn("event_name", F.lit("purchase")).withColumn("value", F.lit(1000.0)))
    late = spark.createDataFrame(late.collect(), fx.events.schema)
    late.write.mode("append").parquet(src)
    finish(q)
    with_late = fx.events.unionByName(late)
    want = mart_rows(mart.build_mart(fx.assignments, with_late))
    assert mart_rows(jobs.stored(spark, table).where("report_date > '2021-01-01'")) == want
    assert want != mart_rows(mart.build_mart(fx.assignments, fx.events))
    finish(start("ck2"))
    assert mart_rows(jobs.stored(spark, table).where("report_date > '2021-01-01'")) == want
    assert jobs.stored(spark, table).where("report_date = '2020-01-01'").first().total_users == 7
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_t6_sees_files_added_after_its_start(spark, tmp_path):
    from tests.conftest import frame
    db = "stream_fresh"
    sinks.create_tables(spark, db, reset=True)
    ev, asg, src = (str(tmp_path / x) for x in ("events", "assignments", "src"))
    at = dt.datetime(2024, 1, 1, 9)
    frame(spark, schemas.ASSIGNMENTS, [dict(user_id="u", run_id="r", variant="A", assigned_at=at)]).write.parquet(asg)

    def buy(i):
        return frame(spark, schemas.EVENTS, [dict(event_id=str(i), user_id="u", event_name="purchase", value=1.0, timestamp=at, run_id="r")])

    buy(1).write.parquet(ev)
    buy(1).write.parquet(src)
    q = jobs.start_mart_refresh(jobs.read_stream(spark, src, schemas.EVENTS), ev, asg, f"{db}.dm_daily_kpi", str(tmp_path / "ck"),
                                metrics=("revenue",))
    q.processAllAvailable()
    buy(2).write.mode("append").parquet(ev)
    buy(2).write.mode("append").parquet(src)
    finish(q)
    r = jobs.stored(spark, f"{db}.dm_daily_kpi").first()
    assert r.total_revenue == 2.0 and r.ctr is None


def test_t7_windowed_streams_drop_what_is_too_late(spark, data, tmp_path):
    fx, root = data
    late_dir = str(tmp_path / "late")
    fx.events.filter("timestamp >= '2024-01-29'").write.parquet(late_dir)
    q = (jobs.active_users(jobs.read_stream(spark, late_dir, schemas.EVENTS, max_files_per_trigger=1)).writeStream
         .format("memory").queryName("t7").outputMode("append").option("checkpointLocation", str(tmp_path / "ck7")).start())
    q.processAllAvailable()
    fx.events.filter("timestamp < '2024-01-03'").limit(1).write.mode("append").parquet(late_dir)
    finish(q)
    assert spark.table("t7").count() > 0
    assert spark.table("t7").filter(F.col("window_start") < F.lit(dt.datetime(2024, 1, 28))).count() == 0
