"""Conversation prefix trie by truncation peeling.

Each distinct sequence of the first d turns (role, text) is a node of depth d; the root has
no turn.  ``peel`` starts at the greatest depth and goes down: at every depth the
conversations that end there are merged with the nodes that survive from below, then the
last turn is stripped and what is left is regrouped by the shorter prefix.  A node's
members, children, leaves and savings are complete when its depth is reached, so nodes are
found and aggregated in the same pass; no table of all prefixes of all conversations
is made.

What runs where.  Turns become digests (SHA-256, chained to 128-bit prefix keys) before they are
gathered, so texts never travel.  Conversations of one sequence are merged first, their ids
streamed in order through SHA-256, and count as one row from then on.  Rows that share their first
``floor`` turns are peeled together inside a task as long as they are light (``LIGHT``
turns); a heavy group -- a third of all conversations may share a
preamble -- is peeled to twice that depth first, where it falls apart, and its levels in between are regrouped
by Spark, with map-side merging, a level at a time.  ``LIGHT`` changes the route only.

Defined results: turns are ordered by their number, NULL first, those of one number by the SHA-256 of
role and text; NULL roles and texts are empty; rows without ``conv_id`` are no conversation. Repeated
rows are repeated turns.  Remainders of negative ids have the id's sign, as in SQL.  An empty table gives
no rows, not even a root.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import attach, ship_by_value, written

ship_by_value(__name__)

# Turns that a group peeled inside one task may have below its floor.
LIGHT = 100_000
ROOT = ""
BATCH = 4096

_PATHS = "conv_id long, path array<string>, sizes array<long>"
# A merged sequence, or a node whose parent is not known yet.
_STATE = ("conv_id long, path array<string>, sizes array<long>, n_convs long, n_children long, n_leaves long, "
          "saved long, ends string")
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
NOTHING = hashlib.sha256(b"").hexdigest()

_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
_PATHS_ARROW = pa.schema([("conv_id", pa.int64()), ("path", _STRINGS), ("sizes", _LONGS)])
_STATE_ARROW = pa.schema([("conv_id", pa.int64()), ("path", _STRINGS), ("sizes", _LONGS),
                          *((c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved")), ("ends", pa.string())])
_PEELED_ARROW = pa.schema([*_STATE_ARROW, ("depth", pa.int64()), ("parent_conv_id", pa.int64())])
_PEELED = _STATE + ", depth long, parent_conv_id long"


def _batched(rows, schema: pa.Schema):
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 1 + len(row["path"] or ())
        if weight >= 16 * BATCH:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest, size
    in code points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("size"))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), "digest", "size")
    in_order = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("t"))
    return in_order.select("conv_id", F.transform("t", lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size"))).alias("turns"))


def grafted(seqs: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """``seqs`` with shared beginnings: of conversation c the first h turns (h = crc32 of the
    decimal id modulo ``most`` + 1) give way to the first h of conversation c - c % ``every``."""
    seqs = written(seqs, "trie-sequences")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = seqs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_llm_base"),
                                                             F.slice("turns", 1, most).alias("_llm_head"))
    empty = F.slice(F.col("turns"), F.lit(1), F.lit(0))
    joined = seqs.withColumn("_llm_base", F.col("conv_id") - F.col("conv_id") % every).join(heads, "_llm_base", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_llm_head", empty), F.lit(1), h),
                                             F.slice(F.col("turns"), h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns"))


def _paths(batches):
    """Prefix keys: each the digest of the shorter prefix's key and the turn."""
    def rows():
        for b in batches:
            for conv, turns in zip(b.column("conv_id").to_pylist(), b.column("turns").to_pylist(), strict=True):
                key, path = ROOT, []
                for t in turns:
                    key = hashlib.blake2b((key + t["digest"]).encode(), digest_size=16).hexdigest()
                    path.append(key)
                yield dict(conv_id=conv, path=path, sizes=[t["size"] for t in turns])

    return _batched(rows(), _PATHS_ARROW)


def _merged(batches):
    """One row per distinct sequence, of rows in order of key and id."""
    def rows():
        now, key, h = None, None, None
        for b in batches:
            keys, ids = b.column("key").to_pylist(), b.column("conv_id").to_pylist()
            for i, (k, c) in enumerate(zip(keys, ids, strict=True)):
                if now is None or k != key:
                    if now is not None:
                        yield dict(now, ends=h.hexdigest())
                    key, h = k, hashlib.sha256(str(c).encode())
                    now = dict(conv_id=c, path=b.column("path")[i].as_py(), sizes=b.column("sizes")[i].as_py(), n_convs=1,
                               n_children=0, n_leaves=0, saved=0)
                else:
                    h.update(f",{c}".encode())
                    now["n_convs"] += 1
        if now is not None:
            yield dict(now, ends=h.hexdigest())

    return _batched(rows(), _STATE_ARROW)


def merged_ends(seqs: DataFrame) -> DataFrame:
    """The distinct sequences of ``seqs`` with their conversations merged."""
    paths = seqs.mapInArrow(_paths, _PATHS)
    key = F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(ROOT))
    rows = paths.withColumn("key", key).repartition("key").sortWithinPartitions("key", "conv_id")
    return written(rows.mapInArrow(_merged, _STATE), "trie-ends")


def _absorb(level: dict, key: str, row: dict, child: bool) -> None:
    """Merge ``row`` -- a conversation that ends here, or a child -- into the node ``key``."""
    node = level.get(key)
    if node is None:
        depth = len(row["path"]) - child
        node = level[key] = dict(conv_id=row["conv_id"], path=row["path"][:depth], sizes=row["sizes"][:depth], n_convs=0,
                                 n_children=0, n_leaves=0, saved=0, ends=None)
    node["conv_id"] = min(node["conv_id"], row["conv_id"])
    node["n_convs"] += row["n_convs"]
    if child:
        node["n_children"] += 1
        node["n_leaves"] += row["n_leaves"]
        node["saved"] += row["saved"]
    else:
        node["ends"] = row["ends"]


def _peel_group(ended: list[dict], floor: int):
    """Nodes deeper than ``floor``, then the one node at ``floor``, of
    sequences that share their first ``floor`` turns."""
    by_depth: dict[int, list] = {}
    for row in ended:
        by_depth.setdefault(len(row["path"]), []).append(row)
    level: dict[str, dict] = {}
    below: list[dict] = []
    for depth in range(max(by_depth), floor - 1, -1):
        for row in by_depth.get(depth, ()):
            _absorb(level, row["path"][-1], row, child=False)
        # The nodes of this depth are complete, so those below know their parents.
        for node in below:
            yield dict(node, path=None, sizes=None, depth=depth + 1, parent_conv_id=level[node["path"][depth - 1]]["conv_id"])
        shorter: dict[str, dict] = {}
        for node in level.values():
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved"] += (node["n_convs"] - 1) * node["sizes"][-1]
            if depth > floor:
                _absorb(shorter, node["path"][-2], node, child=True)
        below = list(level.values())
        level = shorter
    for node in below:
        yield dict(node, depth=None, parent_conv_id=None)


def _peeled(floor: int):
    def run(batches):
        def rows():
            group, key = [], None
            for b in batches:
                keys = b.column("key").to_pylist()
                for k, row in zip(keys, b.select([f.name for f in _STATE_ARROW]).to_pylist(), strict=True):
                    if k != key and group:
                        yield from _peel_group(group, floor)
                        group = []
                    key = k
                    group.append(row)
            if group:
                yield from _peel_group(group, floor)

        return _batched(rows(), _PEELED_ARROW)

    return run


def _node_rows(df: DataFrame, depth, parent) -> DataFrame:
    return df.select("conv_id", depth.cast("long").alias("depth"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                     F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))


def _strip(nodes: DataFrame, ended: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """One level by Spark: ``nodes`` of ``depth`` lose their last turn and meet the conversations that
    end there; (the nodes of depth - 1, the rows of ``nodes`` with their parents)."""
    parent = F.lit(ROOT) if depth == 1 else F.try_element_at("path", F.lit(depth - 1))
    children = nodes.withColumn("key", parent).withColumn("child", F.lit(1))
    here = ended.where(F.size("path") == depth - 1)
    here = here.withColumn("key", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(ROOT))).withColumn("child", F.lit(0))
    cut = [F.slice(c, 1, depth - 1).alias(c) for c in ("path", "sizes")]
    both = children.unionByName(here)
    merged = both.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.sum("n_convs").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum(F.col("n_leaves") * F.col("child")).alias("n_leaves"),
        F.sum("saved").alias("saved"), F.max(F.when(F.col("child") == 0, F.col("ends"))).alias("ends"))
    last = F.lit(0) if depth == 1 else F.try_element_at("sizes", F.lit(depth - 1))
    parents = written(merged.select("key", "conv_id", *cut, "n_convs", "n_children", "n_leaves", "saved", "ends")
                      .withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")))
                      .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * last), f"trie-depth-{depth - 1}")
    total = parents.agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    named = attach(children, parents.select("key", "n_children", F.col("conv_id").alias("of")).withColumnRenamed("n_children", "_llm_n"),
                   "key", "_llm_n", ["conv_id"], total, ["of"])
    return parents.drop("key"), _node_rows(named, F.lit(depth), F.col("of"))


def peel(ended: DataFrame, floor: int = 1, light: int = LIGHT) -> tuple[DataFrame, list[DataFrame]]:
    """(the nodes of depth ``floor``, frames of the deeper ones) of the merged
    sequences ``ended`` that have ``floor`` turns or more."""
    rows = ended.where(F.size("path") >= floor).withColumn("key", F.try_element_at("path", F.lit(floor)))
    weights = written(rows.groupBy("key").agg(F.count("*").alias("n_rows"), F.sum(F.size("path") - floor + 1).alias("weight")),
                      f"trie-weights-{floor}")
    total, heaviest = weights.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.max("weight"), F.lit(0))).first()
    heavy = None
    if heaviest > light:
        weighed = written(attach(rows, weights, "key", "n_rows", ["conv_id"], total, ["weight"]), f"trie-weighed-{floor}")
        heavy, rows = weighed.where(F.col("weight") > light).drop("weight", "key"), weighed.where(F.col("weight") <= light).drop("weight")
    done = written(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_peeled(floor), _PEELED), f"trie-peeled-{floor}")
    nodes = [_node_rows(done.where("depth IS NOT NULL"), F.col("depth"), F.col("parent_conv_id"))]
    state = done.where("depth IS NULL").drop("depth", "parent_conv_id")
    if heavy is not None:
        left, deeper = peel(heavy, 2 * floor, light)
        nodes += deeper
        for depth in range(2 * floor, floor, -1):
            left, found = _strip(left, heavy, depth)
            nodes.append(found)
        state = state.unionByName(left)
    return state, nodes


def trie(seqs: DataFrame, light: int = LIGHT) -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv_id, turns): the smallest
    member ``conv_id``, ``depth``, the parent's ``parent_conv_id`` (NULL: root), ``n_convs`` members, ``n_children``,
    ``n_leaves`` of its subtree, ``saved_tokens`` (code points that sharing saves in its subtree) and the SHA-256 of
    the ids that end at it, ascending and joined by commas."""
    ended = merged_ends(seqs)
    state, nodes = peel(ended, 1, light)
    root, found = _strip(state, ended, 1)
    out = _node_rows(root, F.lit(0), F.lit(None).cast("long"))
    for part in [found, *nodes]:
        out = out.unionByName(part)
    return out
