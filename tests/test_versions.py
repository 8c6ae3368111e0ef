"""Versioned tables: readers never see a mix, a job that dies leaves the old or the new table."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from splitlens.operators import mart
from splitlens.sources import schemas, sinks, versions
from splitlens.sources.schemas import ASSIGNMENTS
from tests.conftest import frame

D = dt.date


def days(spark, users, *numbers):
    return mart.with_updated_at(spark.createDataFrame([(D(2024, 1, n), users) for n in numbers], "report_date date, total_users long"))


def held(spark, t):
    return sorted((r.report_date.day, r.total_users) for r in spark.table(t).collect())


@pytest.fixture
def db(spark):
    sinks.create_tables(spark, "versioned_db", reset=True, versioned=("dm_daily_kpi", "assignments"))
    return "versioned_db"


def test_same_results_as_plain_tables(spark, db):
    t, a = f"{db}.dm_daily_kpi", f"{db}.assignments"
    sinks.create_tables(spark, db, versioned=("dm_daily_kpi", "assignments"))       # idempotent
    sinks.insert_by_name(days(spark, 1, 1, 2, 3, 4), t)
    sinks.range_replace(days(spark, 20, 2, 3), t)
    assert held(spark, t) == [(1, 1), (2, 20), (3, 20)]
    sinks.overwrite_partitions(sinks.staged(days(spark, 5, 3, 9)), t)
    assert held(spark, t) == [(1, 1), (2, 20), (3, 5), (9, 5)]
    assert versions.partition_columns(spark, t) == ["report_date"]
    sinks.replace_table(days(spark, 7, 1), t, partition_by=["report_date"])
    assert held(spark, t) == [(1, 7)]
    rows = [dict(user_id=f"u{i}", run_id=f"r{i % 3}" if i < 8 else None) for i in range(9)]
    sinks.bulk_append(frame(spark, ASSIGNMENTS, rows), a)
    sinks.delete_where(spark, a, None, partition_col="run_id", partition_value="r1")
    sinks.delete_where(spark, a, F.col("user_id") == "u0")
    assert sorted(r.user_id for r in spark.table(a).collect()) == ["u2", "u3", "u5", "u6", "u8"]
    assert len(versions.vacuum(spark, a)) == 2 and spark.table(a).count() == 5
    sinks.create_tables(spark, db, reset=True)
    assert not versions.is_versioned(spark, a) and versions.versions(spark, a) == []


def test_readers_never_see_a_mix(spark, db):
    """A thread reads while days are replaced, deleted and put back; every read is one version, whole."""
    t, seen, stop = f"{db}.dm_daily_kpi", [], threading.Event()
    sinks.replace_table(days(spark, 0, 1, 2, 3), t, partition_by=["report_date"])
    before = spark.table(t)

    def read():
        while not stop.is_set():
            seen.append(tuple(held(spark, t)))

    reader = threading.Thread(target=read)
    reader.start()
    allowed = {((1, 0), (2, 0), (3, 0))}
    try:
        for k in range(1, 5):
            sinks.range_replace(days(spark, k, *([1, 2, 3, 4] if k % 2 else [1, 2])), t)
            allowed.add(tuple(held(spark, t)))
    finally:
        stop.set()
        reader.join()
    assert len(allowed) == 5 and set(seen) <= allowed and len(set(seen)) > 1
    # A frame planned before the switches still reads its version.
    assert {r.total_users for r in before.collect()} == {0}


@pytest.mark.parametrize("step", ["write", "point"])
def test_a_job_that_dies_leaves_the_old_or_the_new_table(spark, db, monkeypatch, step):
    t = f"{db}.dm_daily_kpi"
    sinks.insert_by_name(days(spark, 1, 1, 2), t)
    real = versions.point

    def dies(spark, name, version):
        if step == "point":
            real(spark, name, version)
        raise RuntimeError("killed")

    monkeypatch.setattr(versions, "point", dies)
    with pytest.raises(RuntimeError):
        sinks.range_replace(days(spark, 9, 2), t)
    monkeypatch.undo()
    assert held(spark, t) == ([(1, 1), (2, 1)] if step == "write" else [(1, 1), (2, 9)])
    assert len(versions.vacuum(spark, t)) == 1
    sinks.range_replace(days(spark, 9, 2), t)
    assert held(spark, t) == [(1, 1), (2, 9)]
    assert [f.name for f in spark.table(t).schema] == [f.name for f in schemas.DAILY_KPI if f.name != "report_date"] + ["report_date"]
