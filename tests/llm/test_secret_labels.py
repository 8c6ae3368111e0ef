"""The forest on labels from elsewhere: made findings, forms held out, the table's own findings."""

import re

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from splitlens.llm import queries
from splitlens.llm import secret_labels as L
from splitlens.llm import secret_scan as S
from splitlens.llm.common import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents", "doc_id", "text", "source")


def test_held_out_forms(docs):
    """Trained on some forms, judged on forms that neither the training nor the rule knows."""
    words = S.dictionary(docs, "text")
    made, names = S.features(L.labelled_findings(docs, "text", "source", held_out=False), words)
    assert {r["form"] for r in made.select("form").distinct().collect()} == {f[0] for f in L.FORMS if not f[2]}
    forest = S.train(made, names)
    held = S.features(L.labelled_findings(docs, "text", "source", held_out=True), words)[0].withColumn("rule", S.known_format())
    judged = forest.transform(VectorAssembler(inputCols=names, outputCol="features").transform(held)).withColumn(
        "found_out", F.element_at(vector_to_array("probability"), 2) >= 0.5)
    n = {(r["label"], r["found_out"]): r["count"] for r in judged.groupBy("label", "found_out").count().collect()}
    recall = n[True, True] / (n[True, True] + n.get((True, False), 0))
    precision = n[True, True] / (n[True, True] + n.get((False, True), 0))
    print(f"held-out forms: precision {precision:.3f}, recall {recall:.3f}, {n}")
    assert precision >= 0.95 and recall >= 0.7
    # Where the rule is silent the forest still tells them apart.
    unknown = judged.where("rule IS NULL").agg(F.avg((F.col("label") == F.col("found_out")).cast("double"))).first()[0]
    assert unknown >= 0.75


def test_findings_of_the_table(spark, docs):
    """The labels never saw these findings; the forest agrees with what is known of them by construction."""
    rule = S.candidates(docs, "doc_id", "text", "source").select(F.col("id").alias("doc_id"), "start", S.known_format().alias("rule"))
    got = queries.op10_secret_scan(spark, SF).join(rule, ["doc_id", "start"])
    n = {(r["rule"], r["is_secret"]): r["count"] for r in got.where("rule IS NOT NULL").groupBy("rule", "is_secret").count().collect()}
    assert n.get((True, False), 0) + n.get((False, True), 0) <= 0.02 * sum(n.values()), n


def test_made_values(spark, docs):
    one, two = ([tuple(r) for r in L.labelled_findings(d, "text", "source", None, places=300).collect()] for d in (docs, docs.repartition(5)))
    assert sorted(map(repr, one)) == sorted(map(repr, two)) and len({r[4] for r in one}) > 0.9 * len([r for r in one if r[7] != "image data"])
    by = {}
    for r in one:
        by.setdefault(r[7], []).append(r)
    assert all(re.fullmatch("[0-9a-f]{40}", r[4]) and r[3].endswith('token = "') for r in by["token hex"])
    assert all(re.fullmatch("AKIA[A-Z0-9]{16}", r[4]) for r in by["access key id"])
    assert all(re.fullmatch("xoxb-[0-9]{12}-[A-Za-z0-9+/]{24}", r[4]) for r in by["chat token"])
    assert all(re.fullmatch("[a-z]+-[a-z]+-[a-z]+-20[0-9]{2}", r[4]) for r in by["slug"])


def test_no_places(spark):
    none = spark.createDataFrame([(1, "short", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert L.labelled_findings(none, "text", "source").collect() == []
    got = S.scan(none.limit(0), labelled=L.labelled_findings(none, "text", "source"))
    assert got.collect() == []
