"""Exact duplicates with a two-pass Bloom filter.

Texts are equal when they are identical after every run of ASCII blanks
became one space.  Pass one counts, for every text's hash, its two bits in one
block of a blocked Bloom filter; a bit that two rows set goes into the repeat
filter.  Pass two tests every row against that filter.  A row with a bit that
no other row set is certainly alone: it passes straight through, unshuffled.
Only the others are grouped by their SHA-256, which settles them exactly.

The filter has about 16 bits a row up to ``max_bits`` (64 MB broadcast).
Beyond that many rows it lets more rows through to the grouping, which stays
exact; what is grouped is a hash and an id, not the text.

Defined results: a NULL text counts as empty, and all empty texts are equal.
Of equal texts the smallest id stays; a NULL id counts as the largest; of
equal texts with equal ids (repeated rows) one row stays.  An empty table gives an
empty result.  Other columns never enter the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlens.llm.common import BLANKS, attach, written

BLOCK_BITS = 32768      # one row of the filter: what bitmap_construct_agg holds
MAX_BITS = 1 << 29


def text_hash(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with its blanks normalised."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "), 256)


def filter_blocks(rows: int, max_bits: int = MAX_BITS) -> int:
    """Blocks for about 16 bits a row, a power of two, within ``max_bits``."""
    bits = BLOCK_BITS
    while bits < min(16 * rows, max_bits):
        bits *= 2
    return max(1, min(bits, max_bits) // BLOCK_BITS)


def _with_bits(df: DataFrame, sha: str, blocks: int) -> DataFrame:
    h = F.xxhash64(F.col(sha))
    return df.withColumns({
        "_llm_block": F.pmod(h, F.lit(blocks)),
        "_llm_bit1": F.pmod(F.shiftrightunsigned(h, 30), F.lit(BLOCK_BITS)),
        "_llm_bit2": F.pmod(F.shiftrightunsigned(h, 47), F.lit(BLOCK_BITS)),
    })


def repeat_filter(hashed: DataFrame, sha: str, blocks: int) -> DataFrame:
    """Pass one: per block the bitmap of the bits that two or more rows set."""
    bits = _with_bits(hashed, sha, blocks).select(
        "_llm_block", F.explode(F.array("_llm_bit1", "_llm_bit2")).alias("_llm_bit"))
    twice = bits.groupBy("_llm_block", "_llm_bit").agg(F.count("*").alias("_llm_n")).where("_llm_n > 1")
    return twice.groupBy(F.col("_llm_block").alias("_llm_fb")).agg(
        F.bitmap_construct_agg("_llm_bit").alias("_llm_map"))


def _bit_set(bit: str) -> Column:
    byte = F.conv(F.hex(F.substring("_llm_map", (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), F.pmod(F.col(bit), F.lit(8)).cast("int")) == 1


def possibly_repeated(df: DataFrame, sha: str, filt: DataFrame, blocks: int) -> DataFrame:
    """Pass two: ``df`` with ``_again``, false only for texts that occur once.
    The filter has at most ``max_bits`` bits, so it may be broadcast."""
    tested = _with_bits(df, sha, blocks).join(F.broadcast(filt), F.col("_llm_block") == F.col("_llm_fb"), "left")
    again = F.coalesce(_bit_set("_llm_bit1") & _bit_set("_llm_bit2"), F.lit(False))
    return tested.withColumn("_llm_again", again).drop("_llm_block", "_llm_bit1", "_llm_bit2", "_llm_fb", "_llm_map")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``."""
    hashed = written(docs.select(
        F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("sha"),
        F.monotonically_increasing_id().alias("row")), "dedup-hashed")
    total = hashed.count()
    blocks = filter_blocks(total, max_bits)
    filt = written(repeat_filter(hashed, "sha", blocks), "dedup-filter")
    tested = possibly_repeated(hashed, "sha", filt, blocks)
    alone = tested.where(~F.col("_llm_again")).select(
        F.col("id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha"))
    again = tested.where("_llm_again").drop("_llm_again")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row")))
    groups = written(again.groupBy("sha").agg(F.count("*").alias("group_size"), first.alias("first"))
                     .select("sha", "group_size", F.col("first.id").alias("keep_id"),
                             F.col("first.row").alias("keep_row")), "dedup-groups")
    judged = attach(again, groups, "sha", "group_size", ["row"], total,
                    ["keep_id", "group_size", "keep_row"])
    settled = judged.select("id", "keep_id", "group_size",
                            (F.col("row") == F.col("keep_row")).alias("kept"), "sha")
    return alone.unionByName(settled).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep.

    Rows that the filter clears keep their place; of the others the first by id
    stays.  The rank limit is applied in every map task before the shuffle, so
    a group of copies sends one row per task.
    """
    sha = docs.withColumn("_llm_sha", text_hash(F.col(text_col)))
    hashed = written(sha.select("_llm_sha"), "dedup-hashed")
    blocks = filter_blocks(hashed.count(), max_bits)
    filt = written(repeat_filter(hashed, "_llm_sha", blocks), "dedup-filter")
    tested = possibly_repeated(sha, "_llm_sha", filt, blocks)
    w = Window.partitionBy("_llm_sha").orderBy(F.col(id_col).asc_nulls_last())
    again = (tested.where("_llm_again").withColumn("_llm_rank", F.row_number().over(w))
             .where("_llm_rank = 1").select(*docs.columns))
    return tested.where(~F.col("_llm_again")).select(*docs.columns).unionByName(again)
