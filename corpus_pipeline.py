"""Corpus pipeline: quality, exact copies, near copies, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet in
the shared checkpoint folder and read again as the next stage's documents.  All
stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.llm import exact_dedup, importance, mixing, piece_codec, simhash
from splitlens.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest id, NULL
    last; where ids repeat, the text's hash tells the rows apart."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                   F.xxhash64("text").alias("h"))
    found = simhash.near_duplicates(docs.select(key.alias("_llm_key"), "text"), id_col="_llm_key")
    dropped = found.where(F.col("_llm_key") != F.col("component_id")).select("_llm_key").distinct()
    return docs.withColumn("_llm_key", key).join(dropped, "_llm_key", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of what is left, beside their digests."""
    return piece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=True)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("encode", encode)]

# Gumbel noise, SimHash, dependent rounding and SentencePiece are beyond SQL;
# tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
