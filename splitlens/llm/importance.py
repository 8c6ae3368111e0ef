"""Quality by importance resampling over hashed n-grams.

Two generative models give a text's probability as a product over its hashed n-grams: one
is counted over labelled good documents (the target), one over all documents (the
raw corpus).  The log of their ratio is a document's importance weight.  Documents
are then drawn without replacement in proportion to their weights by the Gumbel top-k trick: each
gets log weight plus Gumbel noise, and the k largest are kept.

n-grams: words and punctuation runs (``\\w+`` or ``[^\\w\\s]+``) and pairs of them as they are, and runs of
1 to 3 word shapes -- capital, lower case, number or punctuation, with its own characters for
punctuation, a mark for a word that repeats the one before -- which see junk whose words
are new.  Each is hashed into ``BUCKETS`` buckets.

A document's weight is the sum over all its n-grams.

k: the share of good documents among the labelled ones, with ``MARGIN`` of the rejected share given back
to the kept, of all documents.  The model is fitted on at most ``MAX_LABELLED`` labelled documents (those of the least
hash of their id); the raw model, the weights and the cut cover all documents.

Defined results: a NULL or empty text has no n-grams, weight 0 and takes part like any other;
labels that are NULL are none, of repeated labels of a document the least counts;
documents equal in id and text share their noise, so rows that tie at the cut
(same score, same id) are kept together; without labels nothing is known and all are kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlens.llm.common import ship_by_value, uniform, written

ship_by_value(__name__)

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
MARGIN = 0.05
SMOOTH = 1.0
SEED = 6
REMEMBERED = 300_000
WEIGHT, SCORE = "_llm_weight", "_llm_score"


class Grams:
    """Hashed n-grams of many texts at a time.  Words are numbered as they come;
    their hashes lie in arrays, up to a bound."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self):
        import re

        self.tokens = re.compile(r"\w+|[^\w\s]+").findall
        self.clear()

    def clear(self):
        import xxhash

        word_hash, shape_hash = np.empty(1 << 12, np.uint64), np.empty(1 << 12, np.uint64)

        class Numbers(dict):
            def __missing__(numbers, word):
                k = len(numbers)
                if k == len(self.word_hash):
                    self.word_hash, self.shape_hash = (np.concatenate([x, np.empty_like(x)]) for x in (self.word_hash, self.shape_hash))
                self.word_hash[k] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), SEED)
                self.shape_hash[k] = xxhash.xxh64_intdigest(shape(word).encode("utf-8", "replace"), SEED + 1)
                numbers[word] = k
                return k

        self.word_hash, self.shape_hash, self.numbers = word_hash, shape_hash, Numbers()

    def buckets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) per n-gram of all texts; an n-gram stays within its text."""
        if len(self.numbers) > REMEMBERED:
            self.clear()
        number, ids, length = self.numbers.__getitem__, [], []
        for text in texts:
            words = self.tokens(text)
            ids.append(np.fromiter(map(number, words), np.int64, len(words)))
            length.append(len(words))
        ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        own = np.repeat(np.arange(len(texts)), length)
        h, s = self.word_hash[ids], self.shape_hash[ids]
        second = own[1:] == own[:-1]
        third = second[1:] & second[:-1]
        s[1:][(h[1:] == h[:-1]) & second] = np.uint64(SEED)          # the same word again
        h2 = (h[1:] * self.MIX + h[:-1]) * self.MIX
        s2 = s[1:] * self.MIX + s[:-1]
        s3 = s2[1:] * self.MIX + s[:-2]
        grams = np.concatenate([h, s, h2[second], s2[second], s3[third]])
        grams ^= grams >> np.uint64(32)
        where = np.concatenate([own, own, own[1:][second], own[1:][second], own[2:][third]])
        return where, ((grams * self.MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def shape(word: str) -> str:
    """Kind of a token: number, all capitals, capital, lower case; punctuation
    by its first characters."""
    if not (word[0].isalnum() or word[0] == "_"):
        return "p" + word[:4]
    if word[0].isdigit():
        return "n"
    return "U" if len(word) > 1 and word.isupper() else "C" if word[0].isupper() else "l"


def pieces(batch: pa.RecordBatch, column: int):
    """Slices of a batch with their texts, about a megabyte of text each."""
    texts, first, held = [], 0, 0
    for at, text in enumerate(batch.column(column)):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held > 1 << 20:
            yield batch.slice(first, at + 1 - first), texts
            texts, first, held = [], at + 1, 0
    if texts:
        yield batch.slice(first), texts


def model_counts(docs: DataFrame, text_col: str, target: Column) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket over all of ``docs`` and over its ``target`` rows.  Every task
    sends at most BUCKETS sums, which are added before they reach the driver."""

    def run(batches):
        grams, raw, own = Grams(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part, texts in pieces(batch, 0):
                where, bucket = grams.buckets(texts)
                good = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                raw += np.bincount(bucket, minlength=BUCKETS)
                own += np.bincount(bucket[good[where]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(own[some])], ["bucket", "raw", "own"])

    sums = docs.select(F.col(text_col).cast("string"), F.coalesce(target, F.lit(False))).mapInArrow(
        run, "bucket long, raw long, own long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("own").alias("own")).collect()
    raw, own = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in sums:
        raw[r["bucket"]], own[r["bucket"]] = r["raw"], r["own"]
    return raw, own


def log_ratio(raw: np.ndarray, own: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw per bucket; the target is smoothed towards the raw model."""
    p_raw = (raw + SMOOTH) / (raw + SMOOTH).sum()
    p_own = (own + SMOOTH * BUCKETS * p_raw) / (own.sum() + SMOOTH * BUCKETS)
    return np.log(p_own) - np.log(p_raw)


def weighted(docs: DataFrame, text_col: str, ratio: np.ndarray) -> DataFrame:
    """``docs`` with the log weight behind its columns."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)
    schema = docs.withColumn(WEIGHT, F.lit(0.0)).schema
    at_text = docs.columns.index(text_col)

    def run(batches):
        grams, ratio = Grams(), held.value
        for batch in batches:
            for part, texts in pieces(batch, at_text):
                where, bucket = grams.buckets(texts)
                # Without any n-gram bincount gives integers.
                weight = np.bincount(where, weights=ratio[bucket], minlength=len(texts)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(weight, pa.float64())], [*part.schema.names, WEIGHT])

    return docs.mapInArrow(run, schema)


def cut_at(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """The (score, id) of rank ``k`` by (score desc, id asc): ranges are counted and
    narrowed, 1,024 at a time, so only counts reach the driver.  None: keep all."""
    low, high, n = rows.agg(F.min("score"), F.max("score"), F.count("*")).first()
    if n is None or k >= n:
        return None
    if k <= 0:
        return math.inf, None
    above = 0                                           # rows known to score over ``high``
    while low < high:
        step = (high - low) / 1024
        if step <= 0 or low + step == low:
            break
        edge = F.least(F.lit(1023), F.floor((F.col("score") - F.lit(low)) / F.lit(step))).cast("int")
        within = rows.where((F.col("score") >= F.lit(low)) & (F.col("score") <= F.lit(high)))
        bins = {r["b"]: r for r in within.groupBy(edge.alias("b")).agg(
            F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b]["n"] >= k:
                low, high = bins[b]["lo"], bins[b]["hi"]
                break
            above += bins[b]["n"]
    ties = rows.where(F.col("score") == F.lit(high))
    return high, _id_at(ties, k - above)


def _id_at(ties: DataFrame, k: int) -> int:
    """The k-th id among rows of one score (NULLs last).  Rows of one id tie and are counted
    together; different ids draw their own noise, so there are few of them."""
    per_id = ties.groupBy("id").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.col("id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    row = per_id.withColumn("upto", upto).where(F.col("upto") >= k).orderBy("upto").select("id").first()
    return row[0]


def scores(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, good_col: str,
           max_labelled: int, margin: float, keep_text: bool) -> tuple[DataFrame, Column]:
    """``docs`` with the log weight and the score as a written table (the text
    only where ``keep_text``), and the condition that keeps a row of it."""
    sample = (labels.where(F.col(good_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_llm_id")).agg((F.min(good_col) > 0).alias("_llm_good"))
              .orderBy(F.xxhash64("_llm_id", F.lit(SEED)), "_llm_id").limit(max_labelled))
    sample = written(sample, "importance-labels")
    share = sample.agg(F.avg(F.col("_llm_good").cast("double"))).first()[0]
    text = F.col(text_col)
    targeted = docs.join(F.broadcast(sample), F.col(id_col) == F.col("_llm_id"), "left").select(
        text.alias("text"), F.col("_llm_good").alias("good"))
    ratio = log_ratio(*model_counts(targeted, "text", F.col("good")))
    noise = -F.log(-F.log(uniform(F.col(id_col), F.lit(SEED))))
    rows = weighted(docs, text_col, ratio).withColumn(SCORE, F.col(WEIGHT) + noise)
    rows = written(rows if keep_text else rows.drop(text_col), "importance-scores")
    if share is None:
        return rows, F.lit(True)
    k = round(rows.count() * (share + margin * (1 - share)))
    cut = cut_at(rows.select(F.col(id_col).alias("id"), F.col(SCORE).alias("score")), k)
    if cut is None:
        return rows, F.lit(True)
    high, last = cut
    at_cut = F.lit(True) if last is None else F.coalesce(F.col(id_col) <= F.lit(last), F.lit(False))
    return rows, (F.col(SCORE) > F.lit(high)) | ((F.col(SCORE) == F.lit(high)) & at_cut)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             good_col: str = "quality", max_labelled: int = MAX_LABELLED, margin: float = MARGIN) -> DataFrame:
    """One row per row of ``docs``: the id, ``log_weight``, ``score`` (with the
    noise) and ``kept``."""
    rows, kept = scores(docs.select(id_col, F.col(text_col).cast("string").alias(text_col)), labels, id_col, text_col,
                        good_col, max_labelled, margin, keep_text=False)
    return rows.select(id_col, F.col(WEIGHT).alias("log_weight"), F.col(SCORE).alias("score"), kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              good_col: str = "quality", max_labelled: int = MAX_LABELLED, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps."""
    rows, kept = scores(docs, labels, id_col, text_col, good_col, max_labelled, margin, keep_text=True)
    return rows.where(kept).select(*docs.columns)
