"""Exact search against sorting all scores."""

import random

import numpy as np
import pytest

from splitlens.llm import topk as T
from splitlens.llm.common import table
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm import brute

NAN, INF = float("nan"), float("inf")


def run(df, k=20, every=20):
    out = T.top_k(df, F.pmod("vec_id", F.lit(every)) == 0, k, 64)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, id int, score double")


def test_whole_table(spark):
    df = table(spark, SF_SMALL, "embeddings", "vec_id", "embedding")
    want = brute.top_k([(r["vec_id"], list(r["embedding"])) for r in df.collect()], lambda i: i % 20 == 0, 20, 64)
    assert run(df) == sorted(want)


def test_edge_rows(spark):
    rows = [(0, [1.0, -0.5]), (20, [0.0, 0.0]), (40, None), (60, [None, 1.0]), (80, [NAN, 1.0]), (100, [INF, 0.0]), (120, []),
            (1, [1.0, 2.0, 3.0]), (2, [0.5]), (3, [1.0, -0.5]), (3, [1.0, -0.5]), (4, []), (None, [1.0, 1.0]), (5, [-INF]), (140, [0.25, 0.25]), (140, [-0.25, 0.5])]
    want = sorted(brute.top_k(rows, lambda i: i % 20 == 0, 20, 64))
    assert run(frame(spark, rows)) == want


def test_ties_and_sparse_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.0, 0.0, 1 / 64, -2 / 64]) for _ in range(12)]) for i in range(700)] + [(i, [1 / 64] * 12) for i in range(700, 1500)]
    assert run(frame(spark, rows), k=7, every=50) == sorted(brute.top_k(rows, lambda i: i % 50 == 0, 7, 64))


def test_blocks_are_merged(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 16)
    monkeypatch.setattr(T, "QUERY_GROUP", 8)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(900)]
    df = frame(spark, rows)
    want = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(df) == sorted(brute.top_k(want, lambda i: i % 20 == 0, 20, 64))


@pytest.mark.parametrize("top", [1, 1 << 20, 1 << 27])
def test_scores_are_exact_at_every_size(top):
    rng = np.random.default_rng(top)
    q, c = rng.integers(-top, top + 1, (70, 6)), rng.integers(-top, top + 1, (90, 8))
    q[rng.random(q.shape) < 0.4] = 0
    c[rng.random(c.shape) < 0.7] = 0
    assert (T.accumulate(q, c).astype(np.int64) == q @ c[:, :6].T).all()


def test_components_of_any_size(spark):
    """Finite components up to the largest floats take part; scores past 64 bits are the nearest of 64 bits."""
    rows = [(0, [1e30, 1.0]), (20, [-1e12, 3.0]), (40, [1.0, -1.0]), (1, [1e30, -2.0]), (2, [-3e38, 0.0]), (3, [1e12, 1e12]), (4, [5.0, 0.25]), (5, [1e7, 1e7])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(frame(spark, rows)) == sorted(brute.top_k(rows, lambda i: i % 20 == 0, 20, 64))


def test_repeated_ids_are_rows(spark):
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [0.5, 0.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    got = run(frame(spark, rows))
    assert got == sorted(brute.top_k(rows, lambda i: i % 20 == 0, 20, 64)) and len(got) == 12


def test_empty_table(spark):
    assert run(frame(spark, [])) == [] and run(frame(spark, [(1, [1.0])])) == []
