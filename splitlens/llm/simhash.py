"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: A-Z lower-cased, words between ASCII blanks, every window of
``shingle`` words joined by spaces (fewer words: all of them; none: fingerprint
zero), XXH64 with seed 42 of each; a bit is set if it is set in over half of them.

Links join fingerprints of at most 4 differing bits.  The 64 bits are cut into
segments of 22, 21 and 21, each padded with zeros to the 23 bits of the binary
Golay code, a perfect code of 4,096 codewords of radius 3.  A segment's keys are the codewords
within 4 bits: one or six.  Two segments of at most 2 differing bits share a key,
since the nearest codeword to the point between them is within 4 of both.
Four errors fall on three segments in one of two ways:

* every segment has at most 2: the fingerprints share a triple of keys;
* one segment has 3 or 4: the others have at most one error together, so one of
  them is equal and the other shares a key.

So each fingerprint files itself under its triples (about 150) and its (equal
segment, key of another) pairs (about 32), each worth some 36 bits.  Buckets are
joined within, and every candidate is verified on all 64 bits.

Larger groups of near copies are not written out pair by pair.  In a bucket of more than
``bucket_limit`` fingerprints a search goes from one member to all within 4 bits, from those
to all that are left, and so on; only each member's component leaves the task.  In a large
group around one text the first steps reach nearly all.  Where that would take more than
``effort`` comparisons, the members are *dense* and take a way of linear cost: two
fingerprints within 4 bits have a common point within 2 bits of both, so every dense
fingerprint is filed under the 2,081 points within 2 bits of it, and those filed at one
point (2,081 at most) are all linked to the least of them.  A key that more than a
quarter of a batch shares makes its members dense at once, so no hot key meets in
one task.  None of the ways loses a link, and connected components do the rest.

Equal fingerprints are one node, so copies are never paired.

Defined results: a NULL text counts as empty; rows without words link with each
other and with any fingerprint within 4 bits of zero; NULL ids never become a
component's id unless all of its ids are NULL; repeated rows get a row each;
an empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splitlens.llm.common import attach, ship_by_value, written
from splitlens.llm.components import connected_components

ship_by_value(__name__)

SHINGLE = 4
MAX_BITS = 4
BUCKET_LIMIT = 24                   # largest bucket that is compared pair by pair
EFFORT = 50_000_000                 # comparisons in one larger bucket
FILED_BY_TASK = 1 << 16             # fingerprints a task files, about
BATCH = 4096                        # fingerprints filed at a time
SEGMENTS = (22, 21, 21)             # low bits first
GOLAY = 0b101011100011              # x^11+x^9+x^7+x^6+x^5+x+1, the generator polynomial
BLOCK = 1 << 15                     # shingles hashed at a time


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp) per row; fp is the fingerprint's 64 bits as a signed long."""

    def run(batches):
        import xxhash

        def fingerprint(text) -> int:
            words = (text or b"").lower().split()       # bytes: only A-Z and ASCII blanks
            if not words:
                return 0
            n = max(1, len(words) - shingle + 1)
            ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
            for at in range(0, n, BLOCK):
                part = words[at:at + BLOCK + shingle - 1]
                windows = zip(*[part[k:] for k in range(shingle)]) if len(words) >= shingle else [part]
                h = np.fromiter((digest(b" ".join(w), 42) for w in windows), np.uint64)
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])

        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                fps = [fingerprint(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary")).mapInArrow(
        run, f"id {kind}, fp long")


def syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of the 23-bit words' division by the generator."""
    word = word.astype(np.uint32)
    for k in range(11, -1, -1):
        word = np.where((word >> (k + 11)) & 1, word ^ np.uint32(GOLAY << k), word)
    return word


def near_errors() -> np.ndarray:
    """(2048, 6): the errors of up to 4 bits that lead from a word of each
    syndrome to a codeword, -1 where there are fewer.  One of up to 2 bits
    stands alone, one of 3 bits has five of 4 bits beside it."""
    errors = [sum(1 << b for b in c) for w in range(5) for c in itertools.combinations(range(23), w)]
    near, filled = np.full((1 << 11, 6), -1, np.int64), [0] * (1 << 11)
    for e, s in zip(errors, syndrome(np.array(errors)).tolist()):
        near[s, filled[s]] = e
        filled[s] += 1
    return near


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    x, out = fps.view(np.uint64), []
    for width in SEGMENTS:
        out.append((x & np.uint64((1 << width) - 1)).astype(np.int64))
        x = x >> np.uint64(width)
    return out


def _segment_keys(seg: np.ndarray, near: np.ndarray) -> np.ndarray:
    """(n, 6) codeword indices of each segment, -1 where there are fewer."""
    e = near[syndrome(seg)]
    return np.where(e >= 0, (seg[:, None] ^ e) >> 11, -1)


def filing_keys(fps: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in fps) of all filings.  A key's low three bits name its
    kind: 0 a triple, 1 to 6 an ordered pair of segments."""
    segs = _segments(fps)
    keys = [_segment_keys(s, near) for s in segs]
    n, made, owner = len(fps), [], []
    where = np.arange(n)

    def add(key, ok):
        made.append(key[ok])
        owner.append(np.broadcast_to(where.reshape((-1,) + (1,) * (key.ndim - 1)), key.shape)[ok])

    a, b, c = keys[0][:, :, None, None], keys[1][:, None, :, None], keys[2][:, None, None, :]
    add(((a << 24 | b << 12 | c) << 3), (a >= 0) & (b >= 0) & (c >= 0))
    for kind, (same, fuzzy) in enumerate(itertools.permutations(range(3), 2), 1):
        add((segs[same][:, None] << 12 | keys[fuzzy]) << 3 | kind, keys[fuzzy] >= 0)
    return np.concatenate(made), np.concatenate(owner)


def filings(fps: DataFrame, hot_share: float = 0.25) -> DataFrame:
    """(key, fp, kind): a row per fingerprint and key (kind 0).  Where more than
    ``hot_share`` of a batch has one key, the batch sends one mark (kind 1) for
    the key, and each of those fingerprints once as dense (kind 2, under a key of
    its own)."""

    def run(batches):
        near = near_errors()
        for batch in batches:
            for part in (batch.slice(k, BATCH) for k in range(0, batch.num_rows, BATCH)):
                x = part.column(0).to_numpy(zero_copy_only=False)
                key, own = filing_keys(x, near)
                order = np.argsort(key, kind="stable")
                key, own = key[order], own[order]
                start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
                size = np.diff(np.r_[start, len(key)])
                many = size > max(BUCKET_LIMIT, hot_share * BATCH)
                hot = np.repeat(many, size)
                dense = x[np.unique(own[hot])]
                marks = key[start[many]]
                keep = ~hot
                out_key = np.r_[key[keep], marks, dense | 7]
                out_fp = np.r_[x[own[keep]], np.zeros(len(marks), np.int64), dense]
                kind = np.r_[np.zeros(keep.sum(), np.int8), np.full(len(marks), 1, np.int8), np.full(len(dense), 2, np.int8)]
                for at in range(0, len(out_key), 1 << 16):
                    cut = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_key[cut]), pa.array(out_fp[cut]), pa.array(kind[cut])], ["key", "fp", "kind"])

    return fps.select("fp").mapInArrow(run, "key long, fp long, kind byte")


def reach(fps: np.ndarray, max_bits: int, effort: int) -> np.ndarray | None:
    """The least member of each fingerprint's component among ``fps`` (ascending,
    distinct); None where finding it takes more than ``effort`` comparisons."""
    root, todo, spent = np.empty_like(fps), np.arange(len(fps)), 0
    while len(todo):
        seed, front, todo = todo[0], todo[:1], todo[1:]
        root[seed] = fps[seed]
        while len(front) and len(todo):
            hit = np.zeros(len(todo), bool)
            for at in range(0, len(front), 64):
                spent += min(64, len(front) - at) * len(todo)
                if spent > effort:
                    return None
                far = fps[front[at:at + 64], None] ^ fps[None, todo]
                hit |= (np.bitwise_count(far.view(np.uint64)) <= max_bits).any(axis=0)
            front, todo = todo[hit], todo[~hit]
            root[front] = fps[seed]
    return root


def verified(filed: DataFrame, bucket_limit: int, max_bits: int, effort: int) -> DataFrame:
    """(u, v, dense) out of ``filed``, dealt and sorted by key: verified pairs of small
    buckets; (member, least of its component) of larger ones; dense members as
    (fp, fp, true)."""
    largest = max(bucket_limit + 1, effort // 8)        # members of a bucket held at a time

    def run(batches):
        def judge(key, fp, kind):
            """All rows of the keys given, sorted by key."""
            own = (key & 7) == 7                                    # dense already
            dense = [fp[own]]
            key, fp, kind = key[~own], fp[~own], kind[~own]
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
            size = np.diff(np.r_[start, len(key)])
            marked = np.add.reduceat(kind, start, dtype=np.int64) > 0 if len(start) else np.empty(0, bool)
            us, vs = [], []
            for k in np.flatnonzero((size > bucket_limit) & ~marked):
                members = np.unique(fp[start[k]:start[k] + size[k]])
                root = reach(members, max_bits, effort)
                if root is None:
                    dense.append(members)
                else:
                    us.append(members[members != root])
                    vs.append(root[members != root])
            dense.append(fp[np.repeat(marked, size) & (kind == 0)])
            small = np.repeat((size <= bucket_limit) & ~marked, size)
            key, fp = key[small], fp[small]
            for step in range(1, bucket_limit):
                same = np.flatnonzero(key[step:] == key[:-step]) if len(key) > step else np.empty(0, int)
                if not len(same):
                    break
                p, q = fp[same], fp[same + step]
                ok = (np.bitwise_count((p ^ q).view(np.uint64)) <= max_bits) & (p != q)
                us.append(np.maximum(p, q)[ok])
                vs.append(np.minimum(p, q)[ok])
            u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, vs))
            pairs = np.unique(np.c_[u, v], axis=0) if len(u) else np.empty((0, 2), np.int64)
            d = np.unique(np.concatenate(dense))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[pairs[:, 0], d]), pa.array(np.r_[pairs[:, 1], d]),
                 pa.array(np.r_[np.zeros(len(pairs), bool), np.ones(len(d), bool)])], ["u", "v", "dense"])

        held, rows = [], 0
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if not len(cols[0]):
                continue
            # Rows of the last key wait for the next batch; of a key that has too
            # many already, a mark is enough to know it again.
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)] if held else cols
            last = np.searchsorted(cols[0], cols[0][-1], "left")
            if last:
                yield judge(*[c[:last] for c in cols])
            held = [c[last:] for c in cols]
            if len(held[0]) > largest and (held[0][0] & 7) != 7:
                more = held[1][held[2] == 0]
                yield pa.RecordBatch.from_arrays([pa.array(more), pa.array(more), pa.array(np.ones(len(more), bool))],
                                                 ["u", "v", "dense"])
                held = [held[0][:1], np.zeros(1, np.int64), np.ones(1, held[2].dtype)]
            elif (held[0][0] & 7) == 7:
                yield judge(*held)
                held = []
        if held:
            yield judge(*held)

    dealt = filed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "u long, v long, dense boolean")


def dense_links(dense: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) edges that connect the dense fingerprints ``fp`` as all their links
    would: two within ``max_bits`` have a common point within half of it (rounded
    down for one, up for the other), so at every point all are linked to the least
    of the nearer ones.  At most 2,081 fingerprints share a point."""

    def run(batches):
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        i, j = np.triu_indices(64, 1)
        ball = np.concatenate([np.zeros(1, np.uint64), one, one[i] | one[j]])
        weight = np.bitwise_count(ball)
        ball, weight = ball[weight <= (max_bits + 1) // 2].view(np.int64), weight[weight <= (max_bits + 1) // 2]
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(x), 64):
                part = x[at:at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part[:, None] ^ ball[None, :]).ravel()), pa.array(np.repeat(part, len(ball))),
                     pa.array(np.tile(weight <= max_bits // 2, len(part)))], ["point", "fp", "near"])

    points = dense.select("fp").mapInArrow(run, "point long, fp long, near boolean")
    least = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("point"))
    return points.select("fp", least.alias("v")).where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    bucket_limit: int = BUCKET_LIMIT, effort: int = EFFORT) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most ``max_bits``
    (0 to 4) differing bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the key scheme covers 0 to 4 differing bits")
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    # A fingerprint becomes some 180 rows: a task files a bounded number of them.
    spark = docs.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-nodes.count() // FILED_BY_TASK))
    found = written(verified(filings(nodes.select("fp").repartition(parts)), bucket_limit, max_bits, effort).distinct(), "simhash-found")
    edges = found.where("not dense").select("u", "v").unionByName(
        dense_links(found.where("dense").select(F.col("u").alias("fp")), max_bits))
    comp = connected_components(edges)
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    named = written(named, "simhash-named")
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m")), "simhash-ids")
    n_nodes = int(ids.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0])
    per_fp = written(attach(named, ids, "root", "m", ["fp"], n_nodes, ["component_id"]), "simhash-components")
    total = int(per_fp.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    out = attach(rows, per_fp, "fp", "n", ["id"], total, ["component_id"])
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
