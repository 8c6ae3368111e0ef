"""Live visitors, incremental mart and id ledger: equal to the batch operators after every
kind of batch -- random, late, repeated, replayed, interrupted."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from splitlens.operators import mart
from splitlens.operators.metrics import variant_users
from splitlens.sources import schemas, sinks
from splitlens.streaming import folds, jobs, ledger, segments, visitors
from splitlens.streaming.ledger import Ledger
from tests.conftest import frame

T = dt.datetime


def finish(q):
    q.processAllAvailable()
    q.stop()


def counts(df):
    return sorted(tuple(r[c] for c in ("run_id", "variant", "visitors")) for r in df.collect())


def some_assignments(seed, n=40):
    rng = random.Random(seed)
    return [dict(user_id=rng.choice(["u1", "u2", "u3", None]) if rng.random() < 0.2 else f"u{rng.randint(0, 30)}",
                 run_id=rng.choice(["r1", "r2", None]), variant=rng.choice("AB"), weight=1.0, experiment_id="e",
                 assigned_at=T(2024, 1, rng.randint(1, 5), rng.randint(0, 23))) for _ in range(n)]


def test_t5_stream_equals_the_table_after_every_batch(spark, tmp_path):
    """Fed by T4's table; a restart goes on, a replayed batch and a new checkpoint change nothing."""
    db = "live_visitors_db"
    sinks.create_tables(spark, db, reset=True)
    table, src, target = f"{db}.assignments", str(tmp_path / "src"), str(tmp_path / "visitors")
    where = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    assert visitors.current_visitors(spark, target).isEmpty()

    def watch(name):
        return visitors.start_live_visitors(jobs.read_stream(spark, where, schemas.ASSIGNMENTS), target, str(tmp_path / name))

    for batch in range(4):
        frame(spark, schemas.ASSIGNMENTS, some_assignments(batch)).write.mode("append").parquet(src)
        finish(jobs.start_assign_once(jobs.read_stream(spark, src, schemas.ASSIGNMENTS), table, str(tmp_path / "t4")))
        finish(watch("ck"))             # a restart from the checkpoint each time
        want = counts(variant_users(jobs.stored(spark, table)))
        assert counts(visitors.current_visitors(spark, target)) == want == counts(jobs.live_visitors(spark, table))
    # The first batch once more, as after a crash before its commit; then all files under a new checkpoint.
    first = f"{target}/segment={segments.name_of(str(tmp_path / 'ck'), 0)}"
    segments.put(sinks.staged(spark.read.parquet(first)), target, segments.name_of(str(tmp_path / "ck"), 0))
    assert counts(visitors.current_visitors(spark, target)) == want
    finish(watch("ck-new"))
    assert counts(visitors.current_visitors(spark, target)) == want
    visitors.compact_visitors(spark, target)
    assert counts(visitors.current_visitors(spark, target)) == want


def test_ledger_opens_only_buckets_that_may_hold_the_ids(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"), buckets=64, bits=1 << 18)
    ids = spark.range(20000).select(F.concat(F.lit("id-"), "id").alias("event_id"))
    assert led.is_empty() and led.may_hold(ids) == []
    led.add(ids, "a")
    fresh = spark.range(10).select(F.concat(F.lit("new-"), "id").alias("event_id"))
    assert led.unseen(fresh).count() == 10 and led.opened == []
    mixed = fresh.unionByName(ids.where("event_id IN ('id-7', 'id-19999')"))
    assert sorted(r.event_id for r in led.unseen(mixed).collect()) == sorted(r.event_id for r in fresh.collect())
    assert 1 <= len(led.opened) <= 2
    read = led.unseen(mixed)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*bucket#\d+ (IN|=)", read)
    led.add(fresh, "b")
    assert led.unseen(mixed).isEmpty() and led.unseen(mixed, but="b").count() == 10
    led.compact()
    assert led.unseen(mixed).isEmpty() and led.unseen(ids.limit(500)).isEmpty() and len(led.opened) == 64
    assert led.unseen(spark.createDataFrame([("other",)], "event_id string")).count() == 1


def test_ledger_is_exact_where_its_filter_is_full(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"), buckets=3, bits=64)
    ids = spark.range(3000).select(F.col("id").cast("string").alias("event_id"))
    led.add(ids.where("event_id % 2 = 0"), "a")
    assert led.unseen(ids).count() == 1500 and led.opened == [0, 1, 2]


def mart_rows(df):
    return sorted((r.report_date, r.total_users, r.click_count, r.total_orders, round(r.total_revenue, 6), round(r.session_depth, 9))
                  for r in df.collect())


def some_events(seed, n=60):
    rng = random.Random(100 + seed)
    names = ["banner_A", "click_banner", "purchase", "page_view", None]
    return [dict(event_id=None if rng.random() < 0.05 else f"e{rng.randint(0, 200)}", user_id=f"u{rng.randint(0, 30)}",
                 event_name=rng.choice(names), value=float(rng.randint(1, 50)), run_id=rng.choice(["r1", "r2"]),
                 timestamp=T(2024, 1, rng.randint(1, 5), rng.randint(0, 23)) if rng.random() < 0.97 else None) for _ in range(n)]


@pytest.fixture
def live(spark, tmp_path, request):
    db = "live_" + request.node.name.replace("[", "_").replace("]", "")[:30]
    sinks.create_tables(spark, db, reset=True)
    return folds.LiveMart(spark, f"{db}.events", f"{db}.assignments", f"{db}.dm_daily_kpi", str(tmp_path / "state"), buckets=4, bits=1 << 16)


def batch_of(spark, seed):
    return folds.both(frame(spark, schemas.EVENTS, some_events(seed)), frame(spark, schemas.ASSIGNMENTS, some_assignments(seed)))


def check(spark, live):
    ev, asg = jobs.stored(spark, live.events), jobs.stored(spark, live.assignments)
    assert ev.count() == ev.select("event_id").distinct().count()
    assert asg.count() == asg.select("user_id", "run_id").distinct().count()
    assert mart_rows(jobs.stored(spark, live.table)) == mart_rows(mart.build_mart(asg, ev))
    return ev.count(), asg.count()


def test_incremental_mart_equals_the_batch_build(spark, live):
    """Random days in every batch (so late rows too), ids that come back on other days,
    batches that run again."""
    sizes = []
    for i, seed in enumerate((0, 1, 0)):
        live.process(batch_of(spark, seed), f"s{i}")
        sizes.append(check(spark, live))
    assert sizes[2] == sizes[1]
    live.process(batch_of(spark, 1), "s1")
    assert check(spark, live) == sizes[2]
    live.compact()
    live.process(batch_of(spark, 3), "s4")
    check(spark, live)


@pytest.mark.parametrize("step, nth, after", [("insert_by_name", 1, True), ("insert_by_name", 2, False), ("put", 2, True),
                                              ("put", 3, False), ("refresh", 1, False)])
def test_interrupted_batches_are_made_up(spark, live, monkeypatch, step, nth, after):
    """The job dies before or after one of its writes, then the batch runs again."""
    live.process(batch_of(spark, 5), "s0")
    owners = {"insert_by_name": [folds, ledger], "put": [segments], "refresh": [folds.LiveMart]}[step]
    real, calls = getattr(owners[0], step), []

    def dies(*a, **k):
        calls.append(1)
        if len(calls) == nth:
            if after:
                real(*a, **k)
            raise RuntimeError("lost")
        return real(*a, **k)

    with monkeypatch.context() as m:
        for owner in owners:
            m.setattr(owner, step, dies)
        with pytest.raises(RuntimeError):
            live.process(batch_of(spark, 6), "s1")
    live.process(batch_of(spark, 6), "s1")
    check(spark, live)


def test_same_id_under_two_dates_is_stored_once(spark, live):
    def at(day):
        return folds.both(frame(spark, schemas.EVENTS, [dict(event_id="x", user_id="u", event_name="purchase", value=1.0, run_id="r1", timestamp=T(2024, 1, day))]),
                          frame(spark, schemas.ASSIGNMENTS, [dict(user_id="u", run_id="r1", variant="A", assigned_at=T(2024, 1, day))]))

    live.process(at(1), "a")
    live.process(at(3), "b")
    assert [r.event_date.day for r in spark.table(live.events).collect()] == [1]
    check(spark, live)


def test_t1_stores_an_id_once_whatever_its_date(spark, tmp_path):
    """Under two dates, in one batch, in two and after a new checkpoint; what was stored before the ledger counts."""
    src, out = str(tmp_path / "src"), str(tmp_path / "events")

    def send(*days, ck="ck", event_id="x"):
        frame(spark, schemas.EVENTS, [dict(event_id=event_id, user_id="u", run_id="r", timestamp=T(2024, 1, d)) for d in days]).write.mode("append").parquet(src)
        finish(jobs.start_ingest(jobs.read_stream(spark, src, schemas.EVENTS), out, str(tmp_path / ck)))
        return sorted((r.event_id, r.event_date.day) for r in spark.read.schema(sinks.table_schema("events")).parquet(out).collect())

    jobs.store_events(frame(spark, schemas.EVENTS, [dict(event_id="old", user_id="u", run_id="r", timestamp=T(2024, 1, 1))]), out)
    assert send(5, 4) == [("old", 1), ("x", 4)]
    assert send(9) == send(2, ck="ck2") == [("old", 1), ("x", 4)]
    assert send(3, event_id="old") == [("old", 1), ("x", 4)]


def test_a_batch_reads_only_the_folds_it_touches(spark, live):
    live.process(batch_of(spark, 0), "a")
    days = spark.createDataFrame([(dt.date(2024, 1, 2),)], "report_date date")
    touched = folds.mart_of(live.of_days(days))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*report_date#\d+ (IN|=)", plan) and touched.count() == 1


def test_live_mart_stream_seeds_and_restarts(spark, live, tmp_path):
    """Tables filled beforehand, then files in two goes with a restart between."""
    old = frame(spark, schemas.EVENTS, [r for r in some_events(50) if r["event_id"]]).dropDuplicates(["event_id"])
    sinks.append_events(old.where("timestamp IS NOT NULL"), live.events)
    sinks.bulk_append(frame(spark, schemas.ASSIGNMENTS, some_assignments(50)).dropDuplicates(["user_id", "run_id"]), live.assignments)
    live.seed()
    live.refresh(live.folds().select("report_date"))
    check(spark, live)
    ev, asg = str(tmp_path / "ev"), str(tmp_path / "asg")
    for seeds in ((51,), (50, 53)):
        for s in seeds:
            frame(spark, schemas.EVENTS, some_events(s, 20)).write.mode("append").parquet(ev)
            frame(spark, schemas.ASSIGNMENTS, some_assignments(s)).write.mode("append").parquet(asg)
        stream = folds.both(jobs.read_stream(spark, ev, schemas.EVENTS, max_files_per_trigger=2),
                            jobs.read_stream(spark, asg, schemas.ASSIGNMENTS, max_files_per_trigger=1))
        finish(live.start(stream, str(tmp_path / "ck")))
        check(spark, live)
