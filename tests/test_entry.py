"""Driver contract: entry smoke, one oracle per query, every query equal to
its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from splitlens.plans import catalog
from splitlens.plans.compare import compare, duck
from tests.conftest import SF_SMALL

QUERIES = {k: v for k, v in E.queries().items() if k in catalog.queries()}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "p_value" in df.columns and df.schema == E.entry(spark).schema


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 40


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_runs_outside_the_repo(tmp_path):
    """Executors (Python workers) must not need the package on their path:
    run the journey from another directory, in another time zone."""
    import os
    import subprocess
    import sys
    import textwrap

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {root!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())
        import __spark_entry__ as E
        n = E.queries()["user_journey"](spark, "/root/testdata/sf0.001").count()
        print("ROWS", n, E.entry(spark).count())
    """))
    env = dict(os.environ, TZ="America/Los_Angeles", PYTHONPATH="")
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_column_types_match_the_oracle(spark, con):
    bad = []
    for name in sorted(ORACLE):
        s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in QUERIES[name](spark, SF_SMALL).schema.fields}
        rel = con.sql(ORACLE[name])
        d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        if s_types != d_types:
            bad.append((name, {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                               if s_types.get(c) != d_types.get(c)}))
    assert not bad, bad


def test_bench_prints_one_json_line(tmp_path):
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="live_pulse,age_segment",
               BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-1000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert set(d["queries"]) == {"live_pulse", "age_segment"} and d["sf"] == 0.001
