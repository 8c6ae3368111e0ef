"""Conversation repair: the auction against enumeration and a dynamic program, the
query against SQL on planted rows, repaired turns, edge cases."""

import hashlib
import itertools
import random
import re

import duckdb
import pytest

from splitlens.llm import queries, turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def outcome(rows, letters):
    """(cost, role initials) of applying ``letters`` to ``rows``; None if they do not fit."""
    cost, out, at = 0, "", 0
    for letter in letters:
        following = "a" if out[-1:] == "u" else "u"
        if letter == "I":
            cost, out = cost + 5, out + following
            continue
        if at == len(rows):
            return None
        initial, fault = rows[at]
        at += 1
        if letter == "D":
            cost += 2
            continue
        if fault == R.MUST_GO:
            return None
        cost += 5 * (fault == R.CUT_SHORT) + (letter == "R")
        out += (initial or "?") if letter == "K" else following
    return (cost, out) if at == len(rows) and re.fullmatch("(s?(ua)+)?", out) else None


def enumerated(rows):
    """Every string of letters with up to two insertions more than rows."""
    best = None
    for n in range(len(rows), len(rows) + 3):
        for letters in itertools.product("DIKR", repeat=n):
            if (found := outcome(rows, letters)) is not None:
                best = min(best or (10**9, ""), (found[0], "".join(letters)))
    return best


def programmed(rows):
    """Backward dynamic program over (row, last role)."""
    far = (10**9, "")

    def with_inserts(b):
        for _ in range(3):
            b = [min(b[q], (b[R.FOLLOWS[q]][0] + 5, "I" + b[R.FOLLOWS[q]][1])) for q in range(4)]
        return b

    best = with_inserts([(0, ""), far, far, (0, "")])
    for initial, fault in reversed(rows):
        now = []
        for q in range(4):
            ways = [(best[q][0] + 2, "D" + best[q][1])]
            if fault != R.MUST_GO:
                more, then = 5 * (fault == R.CUT_SHORT), R.FOLLOWS[q]
                ways.append((best[then][0] + 1 + more, "R" + best[then][1]))
                if initial == " sua"[then] or (initial == "s" and q == 0):
                    kept = best["sua".index(initial) + 1]
                    ways.append((kept[0] + more, "K" + kept[1]))
            now.append(min(ways))
        best = with_inserts(now)
    return best[0]


def test_auction_equals_enumeration():
    for n in range(4):
        for rows in itertools.product([(i, f) for i in ("s", "u", "a", "") for f in range(3)], repeat=n):
            if n < 3 or hash(rows) % 40 == 0:
                assert R.cheapest_edits(list(rows)) == enumerated(rows), rows


def test_auction_equals_dynamic_program():
    rng = random.Random(3)
    for k in range(3000):
        n = rng.choice([63, 64, 65, 128, 200]) if k % 60 == 0 else rng.randint(0, 12)
        faults = [0] * rng.choice([1, 10, 40]) + [1, 2]
        rows = [(rng.choice("sua") if rng.random() < 0.2 else "ua"[i % 2], rng.choice(faults)) for i in range(n)]
        assert R.cheapest_edits(rows) == programmed(rows), rows


def test_work_grows_with_the_rows():
    """20,000 rows in seconds: prices settle block by block."""
    rng = random.Random(9)
    rows = [("ua"[(i + (rng.random() < 0.05)) % 2], rng.choice([0] * 15 + [1, 2])) for i in range(20000)]
    assert R.cheapest_edits(rows) == programmed(rows)


EDGE = [(1, None, None, None), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes"), (1, 1, "assistant", "Yes"), (1, 9, "user", "End!"),
        (2, None, "system", ""), (None, 3, "user", "No id."), (None, None, "assistant", "None?"),
        (3, -5, "assistant", "Begins late. \t"), (3, 4, "tool", "x."), (3, 4, "tool", "a."), (4, 0, "", "no role."), (4, 1, "user", "é" * 50000 + "."),
        (5, 0, "user", "Twice."), (5, 0, "user", "Twice."), (5, 0, "user", "Twice."), (6, 2, "admin", "Same initial."), (-7, 1, "user", " \n\x0b ")]
EDGE += [(10 + c, t, "user" if (t + c // 7) % 2 == 0 else "assistant", f"Turn {t % 9}{'.' if (t * c) % 5 else ''}") for c in range(40) for t in range(c % 12)]
EDGE += [(99, t, "ua"[t % 2] + "x", f"Long {t}." if t % 11 else "") for t in range(400)]


def run(spark, tmp_path, rows, extra=False):
    frame = spark.createDataFrame(rows, SCHEMA)
    if extra:
        frame = frame.selectExpr("*", "1 AS kind", "'x' AS tie", "2.0 AS position", "text AS audit", "role AS initial")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    return queries.op12_turn_repair(spark, str(tmp_path))


@pytest.mark.parametrize("rows", [EDGE, []])
def test_query_equals_sql_on_planted_rows(spark, tmp_path, rows):
    got = run(spark, tmp_path, rows, extra=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op12_turn_repair"])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[c] for c in want.columns)) for r in got.collect())


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "user", "One."), (1, 2, "bot", "Two."), (1, 3, "user", "Three."), (2, 0, "user", "")]
    reports, turns = R.repair(spark.createDataFrame(rows, SCHEMA))
    found = {r["conv_id"]: r for r in reports.collect()}
    # The repeated turn goes; of the last two, one goes and the other becomes the assistant's (D before R).
    assert (found[1]["cost"], found[1]["audit"], found[1]["duplicate"]) == (5, "KDDR", 1)
    assert (found[2]["cost"], found[2]["audit"], found[2]["blank"]) == (2, "D", 1)
    assert sorted(tuple(r) for r in turns.collect()) == [(1, 0, "K", "user", "One."), (1, 1, "R", "assistant", "Three.")]


def test_repaired_turns_are_legal_and_digested(spark):
    reports, turns = R.repair(spark.createDataFrame(EDGE, SCHEMA))
    by_conv = {}
    for r in sorted(turns.collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"], r["position"])):
        by_conv.setdefault(r["conv_id"], []).append(r)
    for rows in by_conv.values():
        assert [r["position"] for r in rows] == list(range(len(rows)))
        assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in rows))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in R.repair_digests(spark.createDataFrame(EDGE, SCHEMA)).collect()}
    assert digests == {r["conv_id"]: hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in by_conv.get(r["conv_id"], ())).encode())
                       .hexdigest() for r in reports.collect()}
