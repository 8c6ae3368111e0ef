"""The pipeline against plain versions of its stages, and the registered
queries against their SQL."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from splitlens.llm import importance, mixing
from splitlens.llm import queries as Q
from splitlens.llm.common import table
from splitlens.plans.compare import compare, duck
from tests.conftest import SF_SMALL
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = [n.split("_")[0] for n in Q.queries()]
    assert names == [f"op{k}" for k in range(1, 14)]
    assert set(Q.queries()) | {"pipeline"} <= set(E.queries()) and set(Q.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    ok, message = compare(Q.queries()[name](spark, SF), duck(SF), Q.oracle_sql()[name])
    assert ok, message


def test_pipeline_equals_plain_stages(spark):
    import sentencepiece

    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels", "doc_id", "quality")
    kept = {r["doc_id"] for r in importance.classify(docs, labels).where("kept").collect()}
    rows = [r for r in docs.collect() if r["doc_id"] in kept]
    first = {i for i, _, _, k, _ in brute.exact([(r["doc_id"], r["text"]) for r in rows]) if k}
    rows = [r for r in rows if r["doc_id"] in first]
    named = {i for i, _, c in brute.near([(r["doc_id"], r["text"]) for r in rows]) if i == c}
    rows = [r for r in rows if r["doc_id"] in named]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, docs.schema)).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for r in rows:
        ids = sp.encode(r["text"], add_eos=True)
        want[(r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(sp.decode(ids).encode()).hexdigest())] += copies[r["doc_id"]]
    got = Counter(tuple(r) for r in P.run(spark, SF_SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == +want and len(got) > 100


EDGE = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (2, None, None, None, None), (None, "", "en", None, 0),
        (3, "x y z " * 9000, "en", "s", 1), (None, "no id", "fr", "t", 5), (4, "a  b c d e", "en", "s", 9), (5, "A b c D e", "en", "u", 9)]


def test_stages_on_edge_rows(spark):
    docs = spark.createDataFrame(EDGE, table(spark, SF_SMALL, "documents").schema)
    empty = docs.limit(0)
    for name, stage in P.STAGES:
        out, none = stage(spark, docs, SF_SMALL), stage(spark, empty, SF_SMALL)
        assert none.count() == 0, name
        if (name, stage) != P.STAGES[-1]:
            assert out.columns == docs.columns and out.count() > 0, name
    assert P.exact(spark, docs, SF_SMALL).count() == 5
    near = Counter((r["doc_id"], r["text"]) for r in P.near(spark, docs, SF_SMALL).collect())
    assert {i for i, _ in near} == {1, 2, 3, None} and near[None, ""] == 0


def test_near_stage_tells_rows_of_one_id_apart(spark):
    rows = [(1, "a b c d e", "en", "s", 9), (7, "a b c  d e", "en", "s", 9), (7, "q r s t u v w x", "en", "s", 9)]
    docs = spark.createDataFrame(rows, table(spark, SF_SMALL, "documents").schema)
    assert {(r["doc_id"], r["text"][0]) for r in P.near(spark, docs, SF_SMALL).collect()} == {(1, "a"), (7, "q")}


def test_last_stage_gives_ids_and_texts(spark):
    docs = spark.createDataFrame(EDGE, table(spark, SF_SMALL, "documents").schema)
    out = P.encode(spark, docs, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    for r in out.collect():
        assert len(r["ids"]) == r["n_tokens"]
        assert hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"]
        assert hashlib.sha256(r["decoded"].encode()).hexdigest() == r["decoded_sha256"]
