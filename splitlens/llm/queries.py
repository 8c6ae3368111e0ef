"""The registered queries opN_<name>, each over its whole table, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlens.llm import (exact_dedup, html_text, importance, mixing, piece_codec, prefix_trie, secret_labels, secret_scan,
                           simhash, token_counts, topk, turn_repair, url_filter, url_sql, warc)
from splitlens.llm.common import table

# (host, path, action): a rule fits its host and all subdomains.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                               table(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"),
                      F.pmod(F.col("vec_id"), F.lit(20)) == 0, k=20, scale=64)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("rep")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return secret_scan.scan(docs, labelled=secret_labels.labelled_findings(docs, "text", "source", held_out=None))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found = turn_repair.repair_digests(turn_repair.damage(rows)).drop("rows").withColumnRenamed("conv_id", "_llm_conv")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return (every.join(found, F.col("conv_id").eqNullSafe(F.col("_llm_conv")), "left").drop("_llm_conv")
            .fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna("", ["audit"])
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", empty)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.grafted(prefix_trie.sequences(rows), every=100, most=5))


_QUERIES = (op1_token_counts, op2_warc, op3_exact_dedup, op4_piece_codec, op5_simhash, op6_quality,
            op7_topk, op8_mixing, op9_url_filter, op10_secret_scan, op11_html_text, op12_turn_repair, op13_prefix_trie)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


# Base 32 of a SHA-1: eight times five hexadecimal digits, four letters each.
_OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
          lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i::INT, 5))::INT >> k) & 31), 1)), '')), '') AS b32,
        max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

_OP3_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""

_OP7_SQL = """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0 AND c.vec_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""

# CRC-32 of a text of ASCII signs, bit by bit.
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i::INT, 1))::UBIGINT),
  lambda acc, b: list_reduce(range(8)::UBIGINT[], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END,
                             xor(acc, b)), 4294967295::UBIGINT))"""


def _plus(cost: str, letters: str, state: str) -> str:
    """A state is nine digits of cost, then the letters of the edits to come."""
    return f"lpad((left({state}, 9)::INT + {cost})::VARCHAR, 9, '0') || '{letters}' || substr({state}, 10)"


def _base(last: int) -> str:
    """The best of Delete, Keep and Rerole of a row after role ``last``."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}[last]
    keep = f"WHEN ini = '{' sua'[after]}' THEN {_plus('more', 'K', f's{after}')}"
    if last == 0:
        keep += f" WHEN ini = 's' THEN {_plus('more', 'K', 's1')}"
    return (f"least({_plus('2', 'D', f's{last}')}, CASE WHEN fault = 1 THEN NULL {keep} END, "
            f"CASE WHEN fault <> 1 THEN {_plus('more + 1', 'R', f's{after}')} END)")


_SIGN = r"regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1)"
_OP12_SQL = f"""
WITH RECURSIVE told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (SELECT *, {_CRC32.format('name')} % 20 AS kind FROM told),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
       FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i,
         left(role, 1) AS ini, {_SIGN} AS sign FROM damaged),
judged AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair,
         CASE WHEN sign = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN sign NOT IN ('.', '!', '?') THEN 'truncated' END AS flaw FROM numbered),
rows AS (SELECT conv_id, i, n, ini, CASE WHEN flaw IS NULL THEN 0 WHEN flaw = 'truncated' THEN 2 ELSE 1 END AS fault,
         CASE WHEN flaw = 'truncated' THEN 5 ELSE 0 END AS more FROM judged),
best(conv_id, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, n + 1, '000000000', '000000010II', '000000005I', '000000000' FROM rows
  UNION ALL
  SELECT conv_id, i, least(b0, {_plus('5', 'I', 'b2')}, {_plus('10', 'II', 'b3')}), least(b1, {_plus('5', 'I', 'b2')}, {_plus('10', 'II', 'b3')}),
         least(b2, {_plus('5', 'I', 'b3')}), least(b3, {_plus('5', 'I', 'b2')})
  FROM (SELECT r.conv_id, r.i, {_base(0)} AS b0, {_base(1)} AS b1, {_base(2)} AS b2, {_base(3)} AS b3
        FROM best b JOIN rows r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1)),
plans AS (SELECT conv_id, left(s0, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM best WHERE i = 1),
letters AS (SELECT conv_id, j, substr(audit, j::INT, 1) AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM plans)),
placed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS place FROM letters),
given AS (SELECT p.conv_id, p.place, p.letter, d.role, d.text, d.ini FROM placed p LEFT JOIN numbered d
          ON d.conv_id IS NOT DISTINCT FROM p.conv_id AND d.i = p.i AND p.letter <> 'I' WHERE p.letter <> 'D'),
turns AS (SELECT conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (place - max((place = 1 AND letter = 'K' AND ini = 's')::INT)
                OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, '') AS line FROM given),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS whole FROM turns GROUP BY conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (flaw = 'blank') AS blank,
         count(*) FILTER (flaw = 'duplicate') AS duplicate, count(*) FILTER (flaw = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_OP13_SQL = f"""
WITH told AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
              FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(digest, size) ORDER BY turn NULLS FIRST, digest) AS turns, conv_id::VARCHAR AS name FROM told GROUP BY conv_id),
cut AS (SELECT *, ({_CRC32.format('name')} % 6)::INT AS h FROM own),
built AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS turns
          FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (SELECT conv_id, depth, sha256(array_to_string(list_transform(turns[:depth], lambda x: x.digest), ',')) AS k,
                    CASE WHEN depth > 0 THEN turns[depth].size ELSE 0 END AS size, depth = len(turns) AS ends
             FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1))::INT AS depth FROM built)),
nodes AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
          FROM prefixes GROUP BY k, depth),
named AS (SELECT n.*, p.k AS parent FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent, count(*) AS n FROM named GROUP BY parent),
below AS (SELECT a.k, sum((c.n IS NULL)::INT) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
          FROM nodes n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN kids c ON c.parent = n.k GROUP BY a.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM named n JOIN below b ON b.k = n.k LEFT JOIN nodes p ON p.k = n.parent LEFT JOIN kids c ON c.parent = n.k
"""


def oracle_sql() -> dict[str, str]:
    """The others rest on tokenizer files, XXH64, a trained model or seeded
    draws, which SQL lacks; tests/llm holds them against brute force."""
    return {"op2_warc": _OP2_SQL, "op3_exact_dedup": _OP3_SQL, "op7_topk": _OP7_SQL, "op9_url_filter": url_sql.OP9_SQL,
            "op12_turn_repair": _OP12_SQL, "op13_prefix_trie": _OP13_SQL}
