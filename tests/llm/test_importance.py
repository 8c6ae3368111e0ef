"""Importance resampling: held-out accuracy, the cut, reruns, edges."""

from collections import Counter

import numpy as np
import pytest

from splitlens.llm import importance as I
from splitlens.llm.common import table

SF = "/root/testdata/sf0.1"


def test_ngrams_equal_a_plain_count():
    """Texts hashed together give the n-grams of each alone, none across texts."""
    texts = ["One two, two two!! THREE 4 four", "", "a", "x y", "One two, two", "é ß\n\n… ###"]
    where, bucket = I.Grams().buckets(texts)
    for k, text in enumerate(texts):
        alone = I.Grams().buckets([text])[1]
        assert Counter(bucket[where == k].tolist()) == Counter(alone.tolist())
    n = 9       # One two , two two !! THREE 4 four
    assert (where == 0).sum() == n + n + (n - 1) * 2 + (n - 2)
    assert 0 <= bucket.min() and bucket.max() < I.BUCKETS


def test_held_out_accuracy(spark):
    """Labels of even ids train; those of odd ids judge."""
    docs, labels = table(spark, SF, "documents", "doc_id", "text"), table(spark, SF, "labels", "doc_id", "quality")
    got = I.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rate = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    good_kept = rate[1, True] / (rate[1, True] + rate.get((1, False), 0))
    bad_kept = rate.get((0, True), 0) / (rate[0, False] + rate.get((0, True), 0))
    assert good_kept > 0.98 and bad_kept < 0.25, rate


def rows():
    good = [(i, f"the cat number {i} sat on the mat and the dog ran to the hill near {i % 13} trees") for i in range(300)]
    bad = [(1000 + i, f"BUY!! NOW!! {i} $$$ WIN!! FREE!! CASH!! ### {i * 7} CLICK!!") for i in range(100)]
    edge = [(2000, None), (2001, ""), (2002, "  \n"), (None, "the cat sat on the mat and the dog ran"), (5, "the cat number 5 sat again"),
            (2003, "the cat sat on the mat " * 30000)]
    return good + bad + edge + [good[7], good[7], bad[3], bad[3]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, id string")


def label_frame(spark):
    found = [(i, 1) for i in range(0, 300, 3)] + [(i, 0) for i in range(1000, 1100, 3)] + [(9, 1), (9, 0), (12, None), (None, 0), (777777, 1)]
    return spark.createDataFrame(found, "doc_id long, quality int")


def test_edges_and_reruns(spark):
    df, labels = frame(spark, rows()), label_frame(spark)
    one = [tuple(r) for r in I.classify(df, labels).collect()]
    two = [tuple(r) for r in I.classify(df.repartition(5), labels).collect()]
    assert Counter((i, round(w, 6), round(s, 6), k) for i, w, s, k in one) == Counter((i, round(w, 6), round(s, 6), k) for i, w, s, k in two)
    assert Counter(r[0] for r in one) == Counter(i for i, _ in rows())
    kept = Counter(r[3] for r in one if r[0] is not None and r[0] < 300)
    junk = Counter(r[3] for r in one if r[0] is not None and 1000 <= r[0] < 1100)
    assert kept[False] == 0 and junk[True] < 0.2 * sum(junk.values())
    assert all(w == 0 for i, w, _, _ in one if i in (2000, 2001, 2002))


def plain_buckets(text):
    """The n-grams of one text, one by one, in Python integers."""
    import re

    import xxhash

    mix, low = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def kind(word):
        if not (word[0].isalnum() or word[0] == "_"):
            return "p" + word[:4]
        if word[0].isdigit():
            return "n"
        return "U" if len(word) > 1 and word.isupper() else "C" if word[0].isupper() else "l"

    words = re.findall(r"\w+|[^\w\s]+", text)
    h = [xxhash.xxh64_intdigest(w.encode(), I.SEED) for w in words]
    s = [I.SEED if k and words[k] == words[k - 1] else xxhash.xxh64_intdigest(kind(w).encode(), I.SEED + 1) for k, w in enumerate(words)]
    grams = h + s
    for k in range(1, len(words)):
        grams.append((h[k] * mix + h[k - 1]) * mix & low)
        grams.append(s[k] * mix + s[k - 1] & low)
        if k > 1:
            grams.append((s[k] * mix + s[k - 1]) * mix + s[k - 2] & low)
    return [(g ^ g >> 32) * mix % (1 << 64) >> 48 for g in grams]


def test_weights_noise_and_cut_equal_a_plain_version(spark):
    """Both models, the ratio, the sums, Gumbel noise, the share and the cut, recomputed one document at a time."""
    import math

    from pyspark.sql import functions as F

    from splitlens.llm.common import uniform

    data, labels = rows(), label_frame(spark)
    grams = [Counter(plain_buckets(t or "")) for _, t in data]
    marks = {}
    for r in labels.collect():
        if r["doc_id"] is not None and r["quality"] is not None:
            marks[r["doc_id"]] = min(r["quality"], marks.get(r["doc_id"], 1))
    raw, own = Counter(), Counter()
    for (i, _), g in zip(data, grams):
        raw.update(g)
        if marks.get(i) == 1:
            own.update(g)
    n_raw, n_own = sum(raw.values()) + I.BUCKETS, sum(own.values()) + I.BUCKETS

    def ratio(b):
        p = (raw[b] + 1) / n_raw
        return math.log((own[b] + I.BUCKETS * p) / n_own) - math.log(p)

    weights = [sum(c * ratio(b) for b, c in g.items()) for g in grams]
    draws = {r["doc_id"]: r["u"] for r in frame(spark, data).select("doc_id", uniform(F.col("doc_id"), F.lit(I.SEED)).alias("u")).collect()}
    scored = [(w - math.log(-math.log(draws[i])), i, w) for (i, _), w in zip(data, weights)]
    share = sum(marks.values()) / len(marks)
    k = round(len(data) * (share + I.MARGIN * (1 - share)))
    cut = sorted(scored, key=lambda r: (-round(r[0], 9), r[1] is None, r[1]))[k - 1]
    got = I.classify(frame(spark, data), labels).collect()
    want = sorted(((i is None, i, round(w, 6), round(s, 6), s > cut[0] - 1e-9) for s, i, w in scored), key=repr)
    assert sorted(((r["doc_id"] is None, r["doc_id"], round(r["log_weight"], 6), round(r["score"], 6), r["kept"]) for r in got), key=repr) == want


def test_kept_rows_have_their_columns(spark):
    df, labels = frame(spark, rows()), label_frame(spark)
    out = I.keep_good(df, labels)
    want = Counter(r["doc_id"] for r in I.classify(df, labels).where("kept").collect())
    assert out.columns == df.columns and Counter(r["doc_id"] for r in out.collect()) == want
    assert {(r["score"], r["id"]) for r in out.collect()} == {(0.5, "x")}       # a column of that name stays as it was


def test_without_labels_all_are_kept(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert I.classify(frame(spark, rows()), none).where("not kept").count() == 0


def test_only_empty_texts(spark):
    got = I.classify(frame(spark, [(1, ""), (2, None), (3, " ")]), label_frame(spark)).collect()
    assert [r["log_weight"] for r in got] == [0.0] * 3


def test_empty_table(spark):
    assert I.classify(frame(spark, []), label_frame(spark)).collect() == []


@pytest.mark.parametrize("k", [1, 2, 7, 50, 150, 199, 200, 0])
def test_the_cut_is_the_kth_row(spark, k):
    rng = np.random.default_rng(k)
    data = [(int(i), float(s)) for i, s in zip(rng.permutation(200), np.round(rng.normal(size=200), 1))]
    cut = I.cut_at(spark.createDataFrame(data, "id long, score double"), k)
    ranked = sorted(data, key=lambda r: (-r[1], r[0]))
    if k >= 200:
        assert cut is None
    elif k == 0:
        assert cut[0] == float("inf")
    else:
        assert cut == (ranked[k - 1][1], ranked[k - 1][0])
