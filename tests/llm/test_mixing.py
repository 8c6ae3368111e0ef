"""Mixing: targets against repeated sharing, rounding against its promises."""

from collections import Counter, defaultdict

import pytest

from splitlens.llm import mixing as M
from splitlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import brute

ROWS = ([(i, "w " * (1 + i * 7 % 90), "abcdefg"[i % 7] if i % 3 else "hot") for i in range(900)]
        + [(2000, None, "a"), (2001, "", None), (2002, "x y", None), (2003, "x y z", ""), (2004, " \t", "blank"),
           (2005, "same", "a"), (2005, "same", "a"), (2005, "same", "a"), (None, "no id", "b"), (None, "no id", "b"),
           (2006, "long " * 60000, "ÿ"), (2007, "é " * 30, "￿"), (2008, "é " * 30, "\U00010000")])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1.0, 2) for i, t, s in rows],
                                 "doc_id long, text string, source string, p double, rows int")


def check(rows, got):
    size = {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.WORDS.findall(t or ""))
    target = brute.mix_targets(size)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter(
        (i, len(brute.WORDS.findall(t or "")), s) for i, t, s in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = r["source"]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s], rel=1e-9, abs=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s], (s, taken[s], target[s])
    return target


def test_rows_with_all_edges(spark):
    got = M.mix(frame(spark, ROWS)).collect()
    check(ROWS, got)


def test_reruns_agree_whatever_the_partitioning(spark):
    one = M.mix(frame(spark, ROWS)).collect()
    two = M.mix(frame(spark, ROWS).repartition(7)).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, two))


def test_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text", "source")
    check([tuple(r) for r in docs.collect()], M.mix(docs).collect())


def test_several_levels_and_marginals(spark):
    """Thousands of documents in one source: a tree of three levels, and each
    document as likely as its share."""
    rows = [(i, "w " * (1 + i % 5), "one") for i in range(12000)] + [(20000 + i, "w w", "two") for i in range(12000)]
    got = M.mix(frame(spark, rows)).collect()
    check(rows, got)
    for n in range(1, 6):
        mine = [r for r in got if r["source"] == "one" and r["size"] == n]
        want = mine[0]["target"] / mine[0]["source_size"]
        assert sum(r["copies"] for r in mine) / len(mine) == pytest.approx(want, abs=0.05)


def test_mixed_documents_follow_the_copies(spark):
    df = frame(spark, ROWS)
    want = Counter()
    for r in M.mix(df).collect():
        want[(r["doc_id"], r["size"], r["source"])] += r["copies"]
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter((r["doc_id"], len(brute.WORDS.findall(r["text"] or "")), r["source"]) for r in out.collect())
    assert got == +want


def test_many_sources_and_many_equal_rows(spark, monkeypatch):
    """Sources by the hundred, ranked and summed over ranges; rows that agree in all columns, unrolled and numbered in runs."""
    monkeypatch.setattr(M, "RUN", 8)
    rows = [(i, "w " * (i % 13), f"host{i % 300:03d}") for i in range(1500)] + [(None, "a b c", "hot")] * 900 + [(7, "x y", None)] * 100
    got = M.mix(frame(spark, rows)).collect()
    check(rows, got)
    assert sorted(r["rep"] for r in got if r["source"] == "hot") == list(range(1, 901))
    want = Counter()
    for r in got:
        want[(r["doc_id"], r["size"], r["source"])] += r["copies"]
    out = Counter((r["doc_id"], len(brute.WORDS.findall(r["text"] or "")), r["source"]) for r in M.mixed_documents(frame(spark, rows)).collect())
    assert out == +want


def test_texts_are_shuffled_once(spark):
    plan = M.mixed_documents(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    with_text = [x for x in plan.split("\n") if "Exchange" in x and "text#" in x]
    assert len(with_text) <= 1 and "text" not in "".join(x for x in plan.split("\n") if "Window" in x)


def test_empty_table_and_nothing_to_take(spark):
    assert M.mix(frame(spark, [])).collect() == []
    got = M.mix(frame(spark, [(1, None, "a"), (2, "", "b")])).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0), (0.0, 0)]
