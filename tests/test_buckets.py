"""Tables bucketed by user: the same results, without a shuffle above the scan of the stored rows."""

import re

import pytest

from splitlens.operators import assignment, metrics
from splitlens.session import co_located
from splitlens.sources import sinks


@pytest.fixture(scope="module")
def stored(spark, fx):
    sinks.create_tables(spark, "bucket_db", reset=True, buckets=8)
    sinks.append_events(fx.events, "bucket_db.events")
    sinks.bulk_append(fx.assignments, "bucket_db.assignments")
    return spark.table("bucket_db.assignments"), spark.table("bucket_db.events")


@pytest.fixture
def large(spark):
    """The plan of a large input: no automatic broadcast, no adaptive execution."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def shuffled_above(plan, table):
    """The exchanges between the root and the scans of ``table``."""
    out, path = [], []
    for line in plan:
        depth = len(re.match(r"[ :+-]*", line)[0])
        path = [(d, x) for d, x in path if d < depth] + [(depth, line)]
        if "FileScan" in line and f".{table}[" in line:
            assert "Bucketed: true" in line, line
            out.append([x for _, x in path if "Exchange" in x])
    return out


def test_readout_joins_bucket_by_bucket(spark, fx, stored, large):
    a, e = stored
    want = sorted(map(tuple, metrics.ab_primary(fx.assignments, fx.events).collect()))
    with co_located(spark):
        got = metrics.ab_primary(a, e)
        plan = plan_of(got)
        assert sorted(map(tuple, got.collect())) == want
    for table in ("events", "assignments"):
        for above in shuffled_above(plan, table):       # only the counts of (run, variant) move
            assert len(above) == 1 and re.search(r"hashpartitioning\(run_id#\d+, variant#", above[0])


def test_insert_if_absent_does_not_shuffle_the_stored_rows(spark, fx, stored, large):
    a, _ = stored
    batch = fx.assignments.unionByName(fx.assignments.limit(5).replace("B", "A", "variant").selectExpr(
        "concat('new', user_id) AS user_id", "experiment_id", "variant", "assigned_at", "run_id", "weight"))
    with co_located(spark):
        new = assignment.assign_once(batch, a)
        plan = plan_of(new)
        rows = new.collect()
    assert len(rows) == 5 and all(r.user_id.startswith("new") for r in rows)
    assert shuffled_above(plan, "assignments") == [[]]


def test_setting_is_put_back(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), co_located(spark):
        assert spark.conf.get(key) == "false" and 1 / 0
    assert spark.conf.get(key) == before
