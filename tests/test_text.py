"""Number text matches Python's formatting, ties included."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from splitlens.functions.text import fixed_str

TRICKY = [63.05 - 7.105427357601002e-15, 63.05, 0.25, 0.35, 2.675, 1.005, -0.04, -0.05, -1.25, 0.0, -0.0, 12.345,
          12.345000000000001, 1e-9, 99.95, 0.5, 1.5, 2.5, -2.5, 1234567.891, (65.22 - 40) / 40 * 100]


def check(spark, xs, d):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.s for r in df.select(fixed_str(F.col("x"), d).alias("s")).collect()]
    assert got == [f"{x:.{d}f}" for x in xs]


def test_tricky_values(spark):
    for d in (0, 1, 2, 4):
        check(spark, TRICKY, d)


def test_random_values(spark):
    rng = random.Random(7)
    xs = [rng.uniform(-1000, 1000) for _ in range(400)] + [round(rng.uniform(-100, 100), 3) for _ in range(400)]
    for d in (1, 2):
        check(spark, xs, d)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=-10 ** 7, max_value=10 ** 7), min_size=1, max_size=30))
def test_decimal_halves(spark, ints):
    check(spark, [i / 200 for i in ints] + [i / 2000 for i in ints], 2)


def test_a_number_beyond_exact_arithmetic_raises(spark):
    import pytest
    from pyspark.sql import functions as F

    from splitlens.functions.text import fixed_str
    ok = spark.createDataFrame([(float(1 << 44),)], "x double").select(fixed_str(F.col("x"), 2).alias("t"))
    assert ok.first().t == "17592186044416.00"
    with pytest.raises(Exception, match="not exact"):
        spark.createDataFrame([(float(1 << 52),)], "x double").select(fixed_str(F.col("x"), 2)).collect()
