"""Writers against a scratch warehouse: DDL, appends, replace, range replace,
deletes, adoption, activation, CSV in and out."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from splitlens.operators import journey, mart, maintenance
from splitlens.sources import schemas, sinks, tables
from splitlens.sources.schemas import ASSIGNMENTS, EVENTS
from tests.conftest import frame

T = dt.datetime
D = dt.date


@pytest.fixture
def ns(spark, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "").replace("-", "_")[:40]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    for t in schemas.EXPERIMENT:
        spark.sql(f"DROP TABLE IF EXISTS {name}.{t}")
    return name


def test_create_tables_idempotent(spark, ns):
    made = sinks.create_tables(spark, ns)
    assert len(made) == len(schemas.EXPERIMENT)
    sinks.create_tables(spark, ns)                       # IF NOT EXISTS
    cols = [c.name for c in spark.catalog.listColumns(f"{ns}.events")]
    assert cols[-1] == "event_date"
    health = {r.table_name: r for r in maintenance.table_health(
        maintenance.catalog_tables(spark, ns, list(schemas.EXPERIMENT) + ["missing"])).collect()}
    assert health["missing"].present is False and health["events"].row_count == 0


def test_append_events_defaults_and_names(spark, ns):
    sinks.create_tables(spark, ns)
    new = spark.createDataFrame([("u1", "purchase", 12.5, "r1"), ("u2", "page_view", None, None)],
                                "user_id string, event_name string, value double, run_id string")
    sinks.append_events(new, f"{ns}.events")
    got = spark.table(f"{ns}.events").collect()
    assert len(got) == 2 and all(r.event_id and r.timestamp and r.event_date for r in got)
    assert sorted(r.value for r in got) == [0.0, 12.5]
    # bulk append with columns in another order lands by name
    a = frame(spark, ASSIGNMENTS, [dict(user_id="u1", experiment_id="e", variant="B",
                                        assigned_at=T(2024, 1, 1), run_id="r1", weight=2.0)])
    sinks.bulk_append(a.select("weight", "run_id", "variant", "user_id", "assigned_at", "experiment_id"),
                      f"{ns}.assignments")
    r = spark.table(f"{ns}.assignments").collect()[0]
    assert (r.user_id, r.variant, r.weight, r.run_id) == ("u1", "B", 2.0, "r1")


def test_mart_replace_and_range_replace(spark, ns):
    sinks.create_tables(spark, ns)
    t = f"{ns}.dm_daily_kpi"

    def day(d, users):
        return spark.createDataFrame([(d, users, 1, 1, 10.0)],
                                     "report_date date, total_users long, click_count long, total_orders long, "
                                     "total_revenue double")

    old = day(D(2024, 1, 1), 1).union(day(D(2024, 1, 2), 2)).union(day(D(2024, 1, 3), 3)).union(day(D(2024, 1, 4), 4))
    sinks.insert_by_name(mart.with_updated_at(old), t)
    new = day(D(2024, 1, 2), 20).union(day(D(2024, 1, 3), 30))
    sinks.range_replace(mart.with_updated_at(new), t)
    got = {r.report_date.day: r.total_users for r in spark.table(t).collect()}
    assert got == {1: 1, 2: 20, 3: 30}                  # day 4 >= min(new) and absent: deleted
    sinks.range_replace(mart.with_updated_at(new), t)   # idempotent
    assert {r.report_date.day: r.total_users for r in spark.table(t).collect()} == got
    sinks.replace_table(new, f"{ns}.mart_copy", partition_by=["report_date"])
    assert spark.table(f"{ns}.mart_copy").count() == 2


def test_delete_run_and_predicate(spark, ns):
    sinks.create_tables(spark, ns)
    rows = [dict(user_id=f"u{i}", experiment_id="e", variant="A", assigned_at=T(2024, 1, 1), run_id=f"r{i % 3}",
                 weight=1.0) for i in range(9)]
    sinks.bulk_append(frame(spark, ASSIGNMENTS, rows), f"{ns}.assignments")
    sinks.delete_where(spark, f"{ns}.assignments", None, partition_col="run_id", partition_value="r1")
    assert sorted({r.run_id for r in spark.table(f"{ns}.assignments").collect()}) == ["r0", "r2"]
    sinks.delete_where(spark, f"{ns}.assignments", F.col("user_id") == "u0")
    left = spark.table(f"{ns}.assignments")
    assert left.count() == 5 and left.filter("user_id = 'u0'").count() == 0


def test_activate_adopt_record(spark, ns):
    sinks.create_tables(spark, ns)
    sinks.activate(spark, f"{ns}.active_experiment")
    sinks.activate(spark, f"{ns}.active_experiment")
    assert spark.table(f"{ns}.active_experiment").count() == 1
    readout = spark.createDataFrame([("r1", "banner", {"title": "x"}, 0.2, 0.01)],
                                    "run_id string, target string, config map<string,string>, lift double, "
                                    "p_value double")
    sinks.adopt(readout, f"{ns}.adoptions", f"{ns}.active_experiment")
    assert spark.table(f"{ns}.active_experiment").count() == 0
    cfg = spark.table(f"{ns}.adoptions").select(F.from_json("variant_config", schemas.VARIANT_CONFIG).alias("c"))
    c = cfg.collect()[0].c
    assert c.winning_variant == "B" and {k: v.toPython() for k, v in c.config.items()} == {"title": "x"} and c.lift == 0.2
    rec = spark.createDataFrame([("r1", "banner", "h", "CTR", 0.01, "Significant Winner", "[]")],
                                "run_id string, target string, hypothesis string, primary_metric string, "
                                "p_value double, decision string, guardrail_results string")
    sinks.append_experiment_record(rec, f"{ns}.experiments")
    r = spark.table(f"{ns}.experiments").collect()[0]
    assert r.created_at is not None and r.exp_id is not None and r.sample_size is None


def test_csv_load_and_journey_export(spark, tmp_path):
    p = tmp_path / "users.csv"
    p.write_text("user_id,name,gender,age,job,segment,joined_at\nu1,A,F,22,x,Student,2024-01-01 10:00:00\n")
    df = tables.read_csv(spark, str(p), schemas.USERS)
    r = df.collect()[0]
    assert r.age == 22 and r.joined_at == T(2024, 1, 1, 10)
    assert tables.read_csv(spark, str(p), infer=True).schema["age"].dataType.simpleString() == "int"
    e = frame(spark, EVENTS, [dict(event_id="1", user_id="u1", event_name="purchase", timestamp=T(2024, 1, 1),
                                   run_id="r")])
    a = spark.createDataFrame([("u1", "r", "B", 1.0)], "user_id string, run_id string, variant string, weight double")
    out = str(tmp_path / "journey")
    journey.write_journey_csv(journey.user_journey(e, a), out)
    back = spark.read.option("header", True).csv(out).collect()
    assert len(back) == 1 and back[0].funnel_stage == "Conversion" and os.path.isdir(out)


def test_load_csv_table(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text("order_id,user_id,order_at,menu_item,amount\no1,u1,2024-01-01 12:00:00,pizza,12.5\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS csv_wh")
    assert sinks.load_csv_table(spark, str(p), "csv_wh.orders", schemas.ORDERS)
    assert sinks.load_csv_table(spark, str(p), "csv_wh.orders", schemas.ORDERS)      # drop and recreate
    r = spark.table("csv_wh.orders").collect()
    assert len(r) == 1 and r[0].amount == 12.5
    with pytest.warns(UserWarning):
        assert not sinks.load_csv_table(spark, str(tmp_path / "missing.csv"), "csv_wh.users", schemas.USERS)


def test_range_replace_computes_its_input_once(spark, ns):
    sinks.create_tables(spark, ns)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    new = spark.range(3).selectExpr("date_add(date'2024-01-01', cast(id as int)) report_date", "id total_users")
    sinks.range_replace(new.mapInArrow(count, new.schema), f"{ns}.dm_daily_kpi")
    assert spark.table(f"{ns}.dm_daily_kpi").count() == 3 and seen.value == 3


def test_delete_restores_the_table_when_the_swap_fails(spark, ns, monkeypatch):
    sinks.create_tables(spark, ns)
    sinks.bulk_append(frame(spark, ASSIGNMENTS, [dict(user_id=f"u{i}", run_id="r") for i in range(4)]), f"{ns}.assignments")
    real = type(spark).sql

    def sql(self, text, *a, **k):
        if "__rewrite RENAME" in text:
            raise RuntimeError("no")
        return real(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError):
        sinks.delete_where(spark, f"{ns}.assignments", F.col("user_id") == "u0")
    monkeypatch.undo()
    spark.sql(f"ALTER TABLE {ns}.assignments RECOVER PARTITIONS")
    assert spark.table(f"{ns}.assignments").count() == 4


def test_copy_keeps_one_row_per_key(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (3, "f")], "k int, v string")
    dst = spark.createDataFrame([(3, "x"), (None, "y")], "k int, v string")
    got = sorted((r.k is None, r.k) for r in maintenance.copy_new_rows(src, dst, ["k"]).collect())
    assert got == [(False, 1), (False, 2), (True, None), (True, None)]


def test_health_with_nothing_present(spark):
    got = maintenance.table_health({"a": None, "b": None}, spark).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0, False), ("b", 0, False)]
    assert maintenance.table_health({"a": None}).count() == 1
