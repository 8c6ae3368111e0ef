"""SimHash near-duplicates against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from splitlens.llm import simhash as S
from splitlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import brute

WORDS = [f"w{k}" for k in range(400)]


def near_rows(seed=1, bases=12, copies=20, words=160):
    """Texts with a few words changed, so that fingerprints differ by a few bits."""
    rng, rows = random.Random(seed), []
    for b in range(bases):
        base = [rng.choice(WORDS) for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                own[rng.randrange(words)] = rng.choice(WORDS)
            rows.append((1000 * b + c, " ".join(own)))
    return rows


def got(df):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


EDGE = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one  TWO"), (6, "a b c d"), (6, "a b c d"), (None, "a b c d e"),
        (7, "A b c D e"), (8, "É b c d e"), (None, "only me here now"), (9, "w " * 70000), (10, "w\n" * 70001)]


def test_golay_words_within_two_bits_share_a_key():
    near, rng = S.near_errors(), np.random.default_rng(3)
    x = rng.integers(0, 1 << 22, 4000)
    flips = np.array([sum(1 << b for b in rng.choice(22, 2, replace=False)) for _ in x])
    for y in (x ^ flips, x ^ (flips & -flips), x):
        a, b = S._segment_keys(x, near), S._segment_keys(y, near)
        shared = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2))
        assert shared.all()
    assert set((near >= 0).sum(axis=1).tolist()) == {1, 6}


def test_every_four_bit_error_shares_a_filing_key():
    near, rng = S.near_errors(), np.random.default_rng(4)
    for errors in (0, 1, 2, 3, 4, 4, 4, 4):
        x = rng.integers(-2**63, 2**63, 300)
        flip = np.array([sum(1 << int(b) for b in rng.choice(64, errors, replace=False)) for _ in x], np.uint64).view(np.int64)
        ka, oa = S.filing_keys(x, near)
        kb, ob = S.filing_keys(x ^ flip, near)
        a, b = ({*zip(o.tolist(), k.tolist())} for k, o in ((ka, oa), (kb, ob)))
        assert {o for o, _ in a & b} == set(range(len(x)))


@pytest.mark.parametrize("limit,effort", [(24, S.EFFORT), (2, S.EFFORT), (2, 60), (2, 0)])
def test_near_copies(spark, limit, effort):
    """Pairs; the search in larger buckets; some or all of them the dense way."""
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(S.near_duplicates(df, bucket_limit=limit, effort=effort)) == Counter(brute.near(rows))


@pytest.mark.parametrize("bits", [1, 3, 4])
def test_reach_equals_all_pairs(bits):
    rng = np.random.default_rng(bits)
    for size in (1, 2, 40, 300):
        x = np.unique(rng.integers(0, 1 << 9, size) | (rng.integers(0, 3, size) << 40))
        classes = brute.classes(x.tolist(), lambda a, b: (a ^ b).bit_count() <= bits)
        least = {c: min(v for v, d in zip(x.tolist(), classes) if d == c) for c in classes}
        assert S.reach(x, bits, 10 ** 9).tolist() == [least[c] for c in classes]
    assert S.reach(np.arange(50), 4, 10) is None


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_fewer_bits(spark, bits):
    rows = near_rows(seed=5, bases=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limit, effort in ((24, S.EFFORT), (2, 0)):
        assert got(S.near_duplicates(df, max_bits=bits, bucket_limit=limit, effort=effort)) == Counter(brute.near(rows, bits))


def test_edge_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in EDGE], "doc_id long, text string, fp int, id string")
    assert got(S.near_duplicates(df)) == Counter(brute.near(EDGE))


def test_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text")
    assert got(S.near_duplicates(docs)) == Counter(brute.near([tuple(r) for r in docs.collect()]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).collect() == []


def test_dense_members_across_batches(spark):
    """Hundreds of fingerprints in one ball, more than any batch holds."""
    rng = np.random.default_rng(0)
    base = 0x0123456789ABCDEF
    fps = {base} | {base ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(600)}
    signed = [f - (f >> 63 << 64) for f in fps]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
        found = S.verified(S.filings(nodes, 8 / S.BATCH), 8, 4, 0).distinct()
        dense = {r["u"] for r in found.where("dense").collect()}
        links = S.dense_links(found.where("dense").selectExpr("u as fp"), 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert dense == set(signed)
    from splitlens.llm.components import connected_components
    comp = connected_components(spark.createDataFrame(links, "u long, v long"))
    assert comp.select("root").distinct().count() == 1 and comp.count() == len(signed)
