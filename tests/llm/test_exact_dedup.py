"""Exact duplicates against the plain version."""

from collections import Counter

import pytest

from splitlens.llm import exact_dedup as X
from splitlens.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import brute

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, " a b"), (None, "a b"), (1, None), (2, ""), (7, "x"), (7, "x"), (7, "y"),
        (None, "z"), (None, "z"), (8, "\x0b\x0c q"), (6, "  q"), (10, "  q"), (11, "lang " * 50000), (12, "lang\n" * 50000)]


def frame(spark, rows):
    # columns that clash with names used inside
    return spark.createDataFrame([(i, t, "r", 1, "s") for i, t in rows], "doc_id long, text string, id string, row int, sha string")


def as_counter(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_edge_rows(spark):
    assert as_counter(X.exact_dedup(frame(spark, ROWS))) == Counter(brute.exact(ROWS))


def test_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert as_counter(X.exact_dedup(docs)) == Counter(brute.exact(rows))


def test_a_full_filter_stays_exact(spark):
    """One block for thousands of rows: nearly every bit is set twice."""
    rows = [(i, f"text {i % 3000}") for i in range(9000)]
    got = as_counter(X.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), max_bits=X.BLOCK_BITS))
    assert got == Counter(brute.exact(rows))


def test_single_rows_pass_the_filter_unshuffled(spark):
    hashed = spark.range(20000).selectExpr("sha2(cast(id as string), 256) sha").unionByName(
        spark.range(10).selectExpr("sha2(cast(id as string), 256) sha"))
    blocks = X.filter_blocks(20010)
    tested = X.possibly_repeated(hashed, "sha", X.repeat_filter(hashed, "sha", blocks), blocks)
    again = tested.where("_llm_again").groupBy("sha").count().collect()
    assert sum(r["count"] == 2 for r in again) == 10          # no repeat is missed
    assert len(again) < 0.05 * 20000                          # and few others are let through


def test_drop_copies_keeps_the_kept_rows(spark):
    got = Counter((r["doc_id"], r["text"]) for r in X.drop_copies(frame(spark, ROWS)).collect())
    kept = Counter((i, sha) for i, _, _, k, sha in brute.exact(ROWS) if k)
    import hashlib
    assert Counter((i, hashlib.sha256(brute.BLANKS.sub(" ", t or "").encode()).hexdigest()) for i, t in got.elements()) == kept
    assert X.drop_copies(frame(spark, ROWS)).columns == frame(spark, ROWS).columns
    odd = frame(spark, ROWS).withColumnsRenamed({"id": "_sha", "row": "_again", "sha": "_n"})
    assert {tuple(r)[2:] for r in X.drop_copies(odd).collect()} == {("r", 1, "s")}


def test_empty_table(spark):
    empty = frame(spark, [])
    assert X.exact_dedup(empty).collect() == [] and X.drop_copies(empty).collect() == []


@pytest.mark.parametrize("rows,bits", [(1, 32768), (10_000, 262144), (10 ** 9, X.MAX_BITS)])
def test_filter_size(rows, bits):
    assert X.filter_blocks(rows) * X.BLOCK_BITS == bits
