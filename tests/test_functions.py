"""Column helpers against closed-form golden values and plain Python."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from splitlens.functions.hashing import bucket_col, bucket_py, bucket_sql_duckdb
from splitlens.functions.normal import erfc_sql, two_sided_p
from splitlens.operators import stats


def test_bucket_golden(spark):
    df = spark.createDataFrame([("user_1",), ("user_2",), ("guest",)], "u string")
    got = {r.u: r.b for r in df.select("u", bucket_col(F.col("u")).alias("b")).collect()}
    assert got == {"user_1": 53, "user_2": 68, "guest": 16}
    assert bucket_py("user_1") == 53


@pytest.mark.parametrize("n", [2, 7, 100, 1000, 65537, 2 ** 31 - 1])
def test_bucket_matches_python(spark, n):
    rng = random.Random(n)
    ids = ["".join(rng.choice("abcdefghij_-0123456789XYZ") for _ in range(rng.randint(0, 24))) for _ in range(300)]
    ids += [str(i) for i in range(100)]
    df = spark.createDataFrame([(i,) for i in ids], "u string")
    rows = df.select("u", bucket_col(F.col("u"), n).alias("b")).collect()
    assert all(r.b == bucket_py(r.u, n) for r in rows)
    con = duckdb.connect()
    for u in ids[:50]:
        assert con.execute(f"select {bucket_sql_duckdb('u', n)} from (select ? as u)", [u]).fetchone()[0] == bucket_py(u, n)


def test_bucket_is_deterministic_and_in_range(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("u"))
    b = df.select(bucket_col(F.col("u")).alias("b"))
    s = b.agg(F.min("b"), F.max("b")).collect()[0]
    assert 0 <= s[0] and s[1] < 100
    assert b.collect() == b.collect()


def test_bucket_rejects_large_n():
    with pytest.raises(ValueError):
        bucket_col("u", 2 ** 31)


def test_p_value_matches_math_erfc(spark):
    zs = [i / 8 for i in range(0, 80)] + [-1.0, -3.3, 12.0, 40.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select("z", two_sided_p("z").alias("p")).collect()
    for r in got:
        want = math.erfc(abs(r.z) / math.sqrt(2))
        assert r.p == pytest.approx(want, rel=1e-11, abs=1e-300)


def test_erfc_sql_in_duckdb_matches_math():
    con = duckdb.connect()
    for x in [0.0, 0.3, 1.0, 2.49, 2.5, 3.7, 6.0, 9.0]:
        v = con.execute(f"select {erfc_sql(f'cast({x!r} as double)')}").fetchone()[0]
        assert v == pytest.approx(math.erfc(x), rel=1e-11)


def test_sample_size_golden(spark):
    d = spark.createDataFrame([(0.10, 0.50), (0.10, 0.05), (0.5, 0.0)], "baseline double, mde double")
    got = [r.n_per_group for r in stats.sample_size(d).collect()]
    assert got == [686, 57763, 0]
    assert got[1] > got[0] > 0


def test_format_delta_golden(spark):
    df = spark.createDataFrame([(0.12345,), (-0.12345,), (0.0001,)], "x double")
    got = [r.d for r in df.select(stats.format_delta(F.col("x")).alias("d")).collect()]
    assert got == ["+12.35%", "-12.35%", "+0.01%"]


def test_retention_rate_golden(spark):
    df = spark.createDataFrame([(100, 40), (100, 0), (0, 0)], "c long, r long")
    got = [r.x for r in df.select(stats.retention_rate(F.col("c"), F.col("r")).alias("x")).collect()]
    assert got == [0.4, 0.0, 0.0]


def test_traffic_plan(spark):
    d = spark.createDataFrame([(686, 50), (686, 30), (686, 70)], "n_per_group long, control_split_pct int")
    rows = {r.control_split_pct: r for r in stats.traffic_plan(d).collect()}
    assert rows[50].total_needed == 1372 and rows[50].control_n == 686 and rows[50].days_needed == 2
    assert rows[30].total_needed == max(int(686 / 0.3), int(686 / 0.7)) == 2286
    assert rows[70].total_needed == 2286
    assert rows[30].control_n == int(2286 * 0.3) and rows[30].test_n == int(2286 * (1 - 0.3))
