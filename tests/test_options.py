"""Operator options: consecutive-day alerts, rounded-up sample size, stratified
sampling weights, table copies, parameterised SQL, display helper."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from splitlens.operators import monitor, reporting, segments, stats
from splitlens.sources import schemas, sinks, tables
from splitlens.sources.schemas import ASSIGNMENTS, EVENTS
from tests.conftest import frame

D = dt.date
T = dt.datetime


def test_alerts_consecutive_days(spark):
    m = spark.createDataFrame([(D(2024, 1, d), c) for d, c in [(1, 0.01), (2, 0.2), (3, 0.01), (4, 0.01), (5, 0.02)]],
                              "report_date date, ctr double")
    one = sorted(r.report_date.day for r in monitor.kpi_alerts(m).collect())
    three = sorted(r.report_date.day for r in monitor.kpi_alerts(m, consecutive_days=3).collect())
    assert one == [1, 3, 4, 5] and three == [5]
    assert "_low_days" not in monitor.kpi_alerts(m, consecutive_days=3).columns


def test_sample_size_ceil(spark):
    d = spark.createDataFrame([(0.10, 0.50)], "baseline double, mde double")
    assert stats.sample_size(d).collect()[0].n_per_group == 686
    assert stats.sample_size(d, ceil=True).collect()[0].n_per_group == 687


def test_sample_by_stratum_weights(spark):
    df = spark.range(20000).select((F.col("id") % 2).cast("string").alias("s"), F.lit(1.0).alias("v"))
    smp = segments.sample_by_stratum(df, "s", {"0": 0.1, "1": 0.5}, seed=3)
    est = {r.s: r.est for r in smp.groupBy("s").agg(F.sum(F.col("v") * F.col("weight")).alias("est")).collect()}
    assert est["0"] == pytest.approx(10000, rel=0.1) and est["1"] == pytest.approx(10000, rel=0.05)


def test_copy_tables_skips_empty(spark):
    for db in ("copy_src", "copy_dst"):
        sinks.create_tables(spark, db, reset=True)
    rows = [dict(user_id=f"u{i}", experiment_id="e", variant="A", assigned_at=T(2024, 1, 1), run_id="r", weight=1.0)
            for i in range(5)]
    sinks.bulk_append(frame(spark, ASSIGNMENTS, rows), "copy_src.assignments")
    sinks.bulk_append(frame(spark, ASSIGNMENTS, rows[:2]), "copy_dst.assignments")
    done = sinks.copy_tables(spark, "copy_src", "copy_dst", {"assignments": ["user_id", "run_id"],
                                                             "events": ["event_id"]})
    assert done == {"assignments": True, "events": False}
    assert spark.table("copy_dst.assignments").count() == 5


def test_run_query_binds_parameters(spark):
    frame(spark, EVENTS, [dict(event_id="1", run_id="r1"), dict(event_id="2", run_id="x' OR '1'='1")]) \
        .createOrReplaceTempView("q_events")
    got = tables.run_query(spark, "SELECT event_id FROM q_events WHERE run_id = :run", {"run": "r1"}).collect()
    assert [r.event_id for r in got] == ["1"]


def test_display_and_user_prefix(spark):
    e = frame(spark, EVENTS, [dict(event_id=str(i), user_id=("user_hist_" if i % 2 else "agent_x_") + str(i),
                                   event_name="x", timestamp=T(2024, 1, 1, 0, i)) for i in range(10)])
    top = monitor.recent_events(e, k=5, user_like="user_hist_%").collect()
    assert [r.event_id for r in top] == ["9", "7", "5", "3", "1"]
    shown = reporting.for_display(e, order_by=["event_id"], limit=3, header_map={"event_id": "이벤트"})
    assert shown.columns[0] == "이벤트" and shown.count() == 3
    assert schemas.CATALOGUE["warehouse"]["users"] is schemas.USERS


def test_assign_once_null_runs_and_earliest(spark):
    from splitlens.operators import assignment
    req = frame(spark, ASSIGNMENTS, [
        dict(user_id="u1", variant="B", assigned_at=T(2024, 1, 1, 10), run_id=None),
        dict(user_id="u1", variant="A", assigned_at=T(2024, 1, 1, 9), run_id="r1"),
        dict(user_id="u1", variant="B", assigned_at=T(2024, 1, 1, 11), run_id="r1"),
        dict(user_id="u2", variant="A", assigned_at=T(2024, 1, 1, 9), run_id=None)])
    stored = frame(spark, ASSIGNMENTS, [dict(user_id="u1", run_id=None), dict(user_id="u1", run_id=None)])
    got = sorted((r.user_id, r.run_id, r.variant) for r in assignment.assign_once(req, stored).collect())
    assert got == [("u1", "r1", "A"), ("u2", None, "A")]
