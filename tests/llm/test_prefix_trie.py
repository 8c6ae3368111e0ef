"""Prefix trie: peeling against plain prefix sets at every route, the query against
SQL on planted rows, edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from splitlens.llm import prefix_trie as P
from splitlens.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The nodes by a set of members per prefix."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [v[3:] for v in sorted(vs)] for c, vs in turns.items()}
    members, built, kids = defaultdict(list), {}, defaultdict(list)
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - abs(c) % 100 * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + seq[h:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
        ends = sorted(c for c in members[k] if len(built[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def peeled(frame, light=P.LIGHT):
    return sorted((tuple(r[c] for c in COLS) for r in P.trie(P.grafted(P.sequences(frame)), light).collect()), key=repr)


def shared(n, deepest, seed):
    """Conversations that share beginnings of several lengths, many of them whole."""
    rng = random.Random(seed)
    base = [("user" if t % 2 == 0 else "assistant", f"shared {t}") for t in range(deepest)]
    rows = []
    for c in range(n):
        cut, more = rng.choice([0, 1, 2, 5, deepest // 2, deepest]), rng.choice([0, 0, 1, 3])
        turns = base[:cut] + [("user", f"own {rng.randint(0, 3)} {t}") for t in range(more)]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(turns)]
    return rows


EDGE = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "tool", "é€"), (None, 1, "user", "no id"), (2, 5, "", ""),
        (100, 0, "user", "base"), (100, 1, "assistant", "of 101"), (101, 0, "user", "x"), (-5, 0, "user", "negative"), (0, 0, "user", "zero"),
        (-100, 3, "user", "minus hundred"), (-101, 3, "user", "its own"), (7, 1, "us", "er"), (8, 1, "use", "r"), (9, 1, "user", "y" * 200000)]


@pytest.mark.parametrize("light", [1, 40, P.LIGHT])
def test_peeling_equals_plain_prefixes(spark, light):
    """One preamble for a third of the conversations; light 1 sends nearly all through Spark's levels."""
    rows = shared(90, 12, 4) + EDGE
    assert peeled(spark.createDataFrame(rows, SCHEMA), light) == plain(rows)


def test_deep_conversations(spark):
    rows = [(c, t, "user", f"{t if t < 300 else (c, t)}") for c in (600, 601, 650) for t in range(350)]
    assert peeled(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


@pytest.mark.parametrize("rows", [EDGE, shared(40, 6, 1), []])
def test_query_equals_sql_on_planted_rows(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role AS key", "1 AS depth", "text AS path", "2 AS child", "3 AS n_convs")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op13_prefix_trie(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op13_prefix_trie"])
    assert sorted(want.columns) == sorted(got.columns)
    found = sorted((tuple(r[c] for c in COLS) for r in got.collect()), key=repr)
    assert found == sorted((tuple(r[want.columns.index(c)] for c in COLS) for r in want.fetchall()), key=repr) == plain(rows)


def test_root_counts_every_conversation(spark):
    rows = shared(60, 8, 2)
    root = next(r for r in P.trie(P.sequences(spark.createDataFrame(rows, SCHEMA))).collect() if r["depth"] == 0)
    assert (root["conv_id"], root["n_convs"], root["parent_conv_id"]) == (min(r[0] for r in rows), len({r[0] for r in rows}), None)
