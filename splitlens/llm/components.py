"""Connected components of an edge table, by alternating stars.

Every edge is moved towards the smallest node it touches, first among the
larger neighbours (large star), then among the smaller ones (small star),
until each component is a star around its smallest node.  The number of
rounds grows with the logarithm of the longest path.  DataFrame operations only;
every half round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import attach, written


def _pull(edges: DataFrame, label: str) -> DataFrame:
    """``edges`` (u, v) with ``m``: the least v of u; a hot u is spread out."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")), f"{label}-least")
    total = int(least.agg(F.coalesce(F.sum("deg"), F.lit(0))).first()[0])
    return attach(edges, least, "u", "deg", ["u", "v"], total, ["m"])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the component's
    smallest node.  Loops, repeated and reversed edges do no harm; edges with a NULL
    end are left out; no edges give no rows."""
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "cc-edges")
    n, was = e.count(), None
    if n == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both, "cc-large").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = written(large, "cc-large")
        small = _pull(large, "cc-small")
        small = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = written(small, "cc-round")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == was:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        was = now
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
