"""Conversation structure repair by an auction algorithm for shortest paths.

The turns of a conversation are to become a legal sequence of roles, ``(s?(ua)+)?``
by their initials, at the least cost.  The edits span a lattice of (row, role of
the last turn given out): Keep, Rerole and Delete lead to the next row, Insert
stays on it.  Its costs are small integers.

Method: an auction (``_auction``).  Every lattice point has a price, never above its
distance to the end.  A path grows from the origin along the cheapest priced arc;
where the last point's price is below that arc's value, the price is raised and the
path contracts by one point.  When the path reaches the end, the origin's price is
its distance.  Prices start at what the rows behind cost whatever their roles, and
the rows are taken in blocks from the back, so the work grows with their number.  In the
converged prices, the arcs of shortest paths are the tight ones (price = cost + price of
the next point); among those that lead to the end the trace takes the least letter.

What runs where: rows are dealt out and sorted by Spark; one pass over narrow rows (turn,
initial, digest) judges each conversation, another one over the whole rows,
with its edits in front, writes the repaired turns.  Both passes stream: no text is
held beyond its Arrow batch, a judged conversation takes some dozens of bytes
a row.  The price sequence and the SHA-256 of a conversation are sequential, so a
conversation is in one task; the texts of different conversations never are together.

Defined results: NULL roles and texts are one space, a NULL turn comes first, a NULL
``conv_id`` is a conversation of its own.  A role that is empty or has another initial
cannot be kept.  Rows of one turn are ordered by the SHA-256
of role and text (equal rows are copies).  An empty table gives no rows.  Texts may have
any length.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import ship_by_value, written

ship_by_value(__name__)

# Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Rows of a block of the auction; only speed depends on it.
BLOCK = 64
# The last role given out: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
CLEAN, MUST_GO, CUT_SHORT = range(3)
BATCH = 4096

REPORT = ("conv_id long, rows long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string")


def _edits(initial: str, fault: int, last: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row: (letter, cost, rows taken, last role then)."""
    out = [("D", DELETE, 1, last), ("I", INSERT, 0, FOLLOWS[last])]
    if fault != MUST_GO:
        more = TRUNCATED if fault == CUT_SHORT else 0
        role = INITIALS.get(initial)
        if role == FOLLOWS[last] or (role == SYSTEM and last == START):
            out.append(("K", KEEP + more, 1, role))
        out.append(("R", REROLE + more, 1, FOLLOWS[last]))
    return out


EDITS = {(i, f): [_edits(i, f, q) for q in range(4)] for i in ("s", "u", "a", "") for f in range(3)}
AT_END = [[("I", INSERT, 0, FOLLOWS[q])] for q in range(4)]
# What a row costs at least, whatever is before it.
LEAST = {row: min(c for of_state in edits for letter, c, step, _ in of_state if step) for row, edits in EDITS.items()}


def _auction(rows: list, lo: int, hi: int, behind: list[int]) -> array:
    """Prices of the lattice points of rows lo..hi, those of row lo exact;
    ``behind`` holds the distances of the points at ``hi``."""
    n = hi - lo
    price = array("q", bytes(8 * 4 * (n + 1)))
    floor = min(behind)
    for k in range(n, -1, -1):
        if k < n:
            floor += LEAST[rows[lo + k]]
        for q in range(4):
            price[4 * k + q] = floor
    for origin in range(4 if lo else 1):
        path = [origin]
        while True:
            point = path[-1]
            k, q = divmod(point, 4)
            best, step = (behind[q], -1) if k == n else (None, 0)
            for _, cost, ahead, then in (AT_END[q] if k == n else EDITS[rows[lo + k]][q]):
                nxt = 4 * (k + ahead) + then
                value = cost + price[nxt]
                if best is None or value < best:
                    best, step = value, nxt
            if price[point] < best:
                price[point] = best
                if len(path) > 1:
                    path.pop()
            elif step < 0:
                break
            else:
                path.append(step)
    return price


def _trace(rows: list, lo: int, hi: int, behind: list[int], price: array, last: int) -> tuple[str, int]:
    """Least letters along tight arcs from (lo, last) to the points at ``hi``,
    and the last role there."""
    n = hi - lo
    tight: dict[int, list] = {}
    leads: set[int] = set()
    for k in range(n, -1, -1):
        for _ in range(2):      # a second look follows insertions within the row
            for q in range(4):
                point = 4 * k + q
                arcs = AT_END[q] if k == n else EDITS[rows[lo + k]][q]
                tight[point] = sorted((letter, 4 * (k + ahead) + then) for letter, cost, ahead, then in arcs
                                      if cost + price[4 * (k + ahead) + then] == price[point] and 4 * (k + ahead) + then in leads)
                if tight[point] or (k == n and behind[q] == price[point]):
                    leads.add(point)
    out, point = [], last
    while True:
        k, q = divmod(point, 4)
        if k == n and behind[q] == price[point]:
            return "".join(out), q
        letter, point = tight[point][0]
        out.append(letter)


def cheapest_edits(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Least cost and the ASCII-least letters of a cheapest repair of ``rows``:
    (role initial, fault), other initials as ''."""
    cuts = list(range(0, len(rows), BLOCK)) + [len(rows)]
    # At the end nothing or an assistant's turn may be last; inserting leads there from the others.
    behind = [0, 2 * INSERT, INSERT, 0]
    blocks = []
    for lo, hi in reversed(list(zip(cuts, cuts[1:], strict=False))):
        price = _auction(rows, lo, hi, behind)
        blocks.append((lo, hi, behind, price))
        behind = list(price[:4])
    cost, letters, last = behind[START], [], START
    for lo, hi, beyond, price in reversed(blocks):
        found, last = _trace(rows, lo, hi, beyond, price, last)
        letters.append(found)
    letters.append({START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[last])
    return cost, "".join(letters)


class _Judge:
    """Facts of one conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id, self.seen, self.rows = conv_id, set(), []
        self.low = self.high = self.turn = self.before = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0]

    def add(self, turn, initial, blank, ends, digest) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if self.rows:
            self.illegal += (self.before, initial) not in LEGAL
        self.before = initial
        kind = 0 if blank else 1 if digest in self.seen else 2 if not ends else None
        self.seen.add(digest)
        if kind is not None:
            self.faults[kind] += 1
        self.rows.append((initial, CLEAN if kind is None else CUT_SHORT if kind == 2 else MUST_GO))

    def report(self) -> dict:
        cost, audit = cheapest_edits(self.rows)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return dict(conv_id=self.conv_id, rows=len(self.rows), gaps=gaps, blank=self.faults[0], duplicate=self.faults[1],
                    truncated=self.faults[2], illegal=self.illegal, cost=cost, audit=audit)


def _batched(rows, schema: pa.Schema):
    """Record batches of an iterator of dicts."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH or (row.get("text") and len(row["text"]) > 1 << 20):
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_REPORT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("rows", "gaps", "blank", "duplicate", "truncated",
                                                                         "illegal", "cost")), ("audit", pa.string())])
_TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                    ("text", pa.string())])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _judged(batches):
    def reports():
        now = None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "blank", "ends", "tie")]
            for conv, turn, initial, blank, ends, tie in zip(*cols, strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        yield now.report()
                    now = _Judge(conv)
                now.add(turn, initial, blank, ends, tie)
        if now is not None:
            yield now.report()

    return _batched(reports(), _REPORT)


def _applied(batches):
    """Repaired turns; a conversation's audit comes in front of its rows."""
    def turns():
        conv, letters, at, place, last = None, "", 0, 0, START

        def inserted():
            nonlocal at, place, last
            while at < len(letters) and letters[at] == "I":
                at, last = at + 1, FOLLOWS[last]
                yield dict(conv_id=conv, position=place, edit="I", role=ROLES[last], text="")
                place += 1

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "kind", "initial", "role", "text")]
            for c, kind, initial, role, text in zip(*cols, strict=True):
                if kind == 0:
                    yield from inserted()
                    conv, letters, at, place, last = c, text, 0, 0, START
                    continue
                yield from inserted()
                letter, at = letters[at], at + 1
                if letter == "D":
                    continue
                if letter == "R":
                    last = FOLLOWS[last]
                    role = ROLES[last]
                else:
                    last = INITIALS[initial]
                yield dict(conv_id=c, position=place, edit=letter, role=role, text=text)
                place += 1
        yield from inserted()

    return _batched(turns(), _TURNS)


def _digested(batches):
    def digests():
        conv, h = None, None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "position", "role", "text")]
            for c, place, role, text in zip(*cols, strict=True):
                if place == 0:
                    if h is not None:
                        yield dict(conv_id=conv, repaired_sha256=h.hexdigest())
                    conv, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
        if h is not None:
            yield dict(conv_id=conv, repaired_sha256=h.hexdigest())

    return _batched(digests(), _DIGESTS)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with reproducible faults: by
    crc32(``conv_id:turn``) modulo 20 a row is dropped (0), has its text emptied
    (1) or stripped of ``.!?`` (2), is repeated (3) or given to the user (4)."""
    def known(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                known("role").alias("role"), known("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
            .withColumn("copy", F.explode("copies")).drop("copies", "copy"))


def _rows(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"))
    initial = F.substring("role", 1, 1)
    return rows.select("conv_id", "turn", "role", "text",
                       F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("")).alias("initial"),
                       F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("tie"))


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *keys)


def judge(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its ``rows``, the turn numbers missing between its
    first and last (``gaps``), rows that are ``blank``, ``duplicate`` or ``truncated`` (the
    first of these counts), ``illegal`` neighbours, and the cheapest repair: its ``cost`` and ``audit``,
    the edits' initials (Delete, Insert, Keep, Rerole) in order, ASCII-least among the cheapest."""
    last_sign = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = _rows(conversations).select("conv_id", "turn", "initial", (last_sign == "").alias("blank"),
                                         last_sign.isin(".", "!", "?").alias("ends"), "tie")
    return written(_in_order(narrow, "turn", "tie").mapInArrow(_judged, REPORT), "turn-reports")


def _repaired(conversations: DataFrame, reports: DataFrame) -> DataFrame:
    rows = _rows(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", "tie", "initial", "role", "text")
    heads = reports.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("tie"),
                           F.lit("").alias("initial"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return _in_order(rows.unionByName(heads), "kind", "turn", "tie").mapInArrow(
        _applied, "conv_id long, position long, edit string, role string, text string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``judge``'s reports, the repaired turns: conv_id, position from 0, edit, role, text)."""
    reports = judge(conversations)
    return reports, _repaired(conversations, reports)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``: of the repaired turns as
    ``role:text``, joined by newlines."""
    reports = judge(conversations)
    # The repaired turns leave their task in order, so they are digested in the same one.
    digests = _repaired(conversations, reports).mapInArrow(_digested, "conv_id long, repaired_sha256 string")
    of = digests.select(F.col("conv_id").alias("_llm_conv"), "repaired_sha256")
    return (reports.join(of, F.col("conv_id").eqNullSafe(F.col("_llm_conv")), "left").drop("_llm_conv")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))))
