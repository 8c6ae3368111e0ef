"""Plan shape regressions, checked on the plan a large input gets (adaptive
execution and automatic broadcast off)."""

import re

import pytest

from pyspark.sql import functions as F

from splitlens.operators import journey, metrics, monitor
from splitlens.plans import catalog
from splitlens.sources import sinks
from splitlens.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL

QUERIES = catalog.queries()


@pytest.fixture
def static_plan(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)

    def plan(name):
        return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()

    yield plan
    for k, v in old.items():
        spark.conf.set(k, v)


FOLDED = ["ab_primary", "ab_stats", "guardrail_counts", "weighted_metrics", "kpi_mart", "kpi_etl",
          "baseline_rate", "experiment_record", "user_metrics"]


@pytest.mark.parametrize("name", FOLDED)
def test_no_expand_and_partial_aggregation_before_shuffles(static_plan, name):
    plan = static_plan(name)
    assert "Expand" not in plan                      # no multi-distinct aggregation
    assert "partial_max(" in plan or "partial_count(" in plan   # events are folded map-side
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning", line) and "Reused" not in line:
            # The operator feeding each hash exchange is an aggregate (partial
            # or, for the assignment side of a join, a plain projection of it).
            child = next((lines[j] for j in range(i + 1, len(lines)) if lines[j].strip()), "")
            assert "HashAggregate" in child or "Project" in child or "Filter" in child, (name, line, child)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_scans_are_pruned(static_plan, name):
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", static_plan(name)):
        cols = [c.split(":")[0] for c in schema.split(",")]
        assert "props" not in cols and len(cols) <= 6, (name, schema)


def test_journey_splits_groups(static_plan, spark):
    """Without hot groups: one shuffle of the events and a plain window.  With them: the only windows over a
    whole (run, user) run over slice facts and assignments, and the broadcasts hold hot groups and boundaries."""
    plan = static_plan("user_journey")
    assert "MapInPandas" not in plan and "BroadcastExchange" not in plan and "_slice" not in plan
    fx = Fixtures(spark, SF_SMALL)
    e = fx.events.withColumn("_user", F.concat(F.lit("u"), "user_id"))
    hot = spark.createDataFrame([("run_20240105", "u1", 1000)], "run_id string, _user string, of long")
    plan = journey._sliced_journey(e, hot, fx.assignments, 10, 2)._jdf.queryExecution().executedPlan().toString()
    for line in re.findall(r"\n[ +:*()0-9-]*Window [^\n]*", plan):
        assert "_slice" in line.split("windowspecdefinition(")[1] or "variant" in line or "user_id" in line, line
    assert plan.count("hashpartitioning(run_id") >= 3
    lines = plan.split("\n")
    for at, line in enumerate(lines):
        if "BroadcastExchange" in line and "Reused" not in line:      # the hot groups or their boundaries
            assert "collect_list" in lines[at + 1] or "Scan ExistingRDD" in "".join(lines[at + 1:at + 4]), lines[at:at + 4]


def test_stored_events_are_pruned(spark, fx):
    db = "plan_db"
    sinks.create_tables(spark, db, reset=True)
    sinks.append_events(fx.events, f"{db}.events")
    stored = spark.table(f"{db}.events")

    def filters(df):
        return re.findall(r"PartitionFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())

    as_of = "2024-01-30 12:00:00"
    pulse = monitor.live_pulse(stored, as_of)
    assert all("event_date" in f for f in filters(pulse)) and filters(pulse)
    assert pulse.first() == monitor.live_pulse(fx.events, as_of).first()
    assert all("event_date" in f for f in filters(monitor.recent_events(stored, since="2024-01-29 00:00:00")))
    run = "run_20240105"
    assert all(f"{run}" in f for f in filters(metrics.ab_primary(fx.assignments, stored, run_ids=[run])) if "run_id" in f)
    assert any("run_id" in f for f in filters(metrics.ab_primary(fx.assignments, stored, run_ids=[run])))
    assert stored.where(F.col("run_id") == run).count() == fx.events.where(F.col("run_id") == run).count()


def test_broadcasts_only_bounded_frames(static_plan):
    # With automatic broadcast off, every broadcast left is an explicit hint on
    # a frame bounded by construction.
    for name, expected in [("ab_primary", 0), ("kpi_mart", 0), ("traffic_plan", 2), ("user_segments", 1),
                           ("assign_variant", 1)]:
        assert static_plan(name).count("BroadcastExchange") == expected, name
