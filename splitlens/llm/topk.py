"""Exact top-k by integer inner product, term at a time.

A vector's components, scaled and floored, are the weights of its terms (the
dimensions).  Each task holds one group of queries and one slice of the candidates.  It
builds, dimension by dimension, the postings of a block of candidates (those with a non-zero
weight); every query that has the dimension scatters its weight times the postings
into its dense row of scores.  After the last dimension the rows are exact scores of the
whole block; a partition selection takes each row's best, which are merged block by block.
A second step merges the tasks' best per query.

Queries and candidates meet on a grid: queries are copied to every slice and
candidates to every query group, all keyed by (group, slice), so a task's share is bounded
however many of either there are, and nothing passes through the driver.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part,
neither as query nor as candidate.  Missing dimensions weigh zero, so lengths may
differ and an empty vector scores 0 with all.  Rows with a NULL id take no part.  Rows that repeat an id are rows
of their own: each is a query (if the id is) and a candidate for all others, its
twins too.  Scores are exact integers; one beyond 64 bits counts as the largest or least of
them.  Ties go to the smaller id.  An empty table gives an empty result.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlens.llm.common import ship_by_value, written

ship_by_value(__name__)

QUERY_GROUP = 4096          # queries in a task, on average
SLICE = 16384               # candidates in a task, on average
BLOCK = 2048                # candidates scored at a time
ROWS = 64                   # query rows scored at a time: their scores stay in cache


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def weights(vector: Column, scale: float) -> Column:
    """Whole numbers as doubles, floats of any size included: from 2^53 on a double is whole."""
    def floored(x: Column) -> Column:
        y = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, floored)


def _matrix(column) -> np.ndarray:
    """Rows of weights, short ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(length), int(length.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < length[:, None]] = column.flatten().to_numpy()
    return out


def accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of all queries (rows) with all candidates of a block."""
    dims = min(queries.shape[1], block.shape[1])
    top = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(1, dims)
    if top >= 1 << 62:          # whole numbers of any size, then the nearest of 64 bits
        exact = [[[int(x) for x in row[:dims]] for row in m] for m in (queries, block)]
        return np.array([[min(max(sum(map(mul, q, c)), 1 - (1 << 63)), (1 << 63) - 1) for c in exact[1]] for q in exact[0]],
                        np.int64).reshape(len(queries), len(block))
    kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64   # all exact
    postings = []
    for d in range(dims):
        at = np.flatnonzero(block[:, d])
        if len(at):                     # a posting list of nearly the whole block is a slice
            whole = 2 * len(at) > len(block)
            postings.append((d, slice(None) if whole else at, block[:, d].astype(kind) if whole else block[at, d].astype(kind)))
    scores = np.zeros((len(queries), len(block)), kind)
    buffer = np.empty((ROWS, len(block)), kind)
    for first in range(0, len(queries), ROWS):
        part, out = queries[first:first + ROWS].astype(kind), scores[first:first + ROWS]
        for d, at, value in postings:
            has = part[:, d] != 0
            if has.all() and isinstance(at, slice):
                product = np.multiply(part[:, d, None], value[None, :], out=buffer[:len(part)])
                np.add(out, product, out=out)
            else:
                rows = np.flatnonzero(has)
                if isinstance(at, slice):
                    out[rows] += part[rows, d, None] * value[None, :]
                else:
                    out[rows[:, None], at[None, :]] += part[rows, d, None] * value[None, :]
    return scores


def select_best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each row's ``k`` best columns, unordered; of equal scores the
    first columns (``ids`` ascend).  ``own`` marks cells that don't compete; they may be returned with the
    least integer as score where a row has fewer than ``k`` others."""
    low = np.iinfo(np.int64).min
    scores = scores.astype(np.int64)
    width = len(ids)
    if np.abs(scores).max(initial=0) < (1 << 62) // width:      # score and column in one number: no ties
        key = scores * width + np.arange(width - 1, -1, -1)
        key[own] = low
        best = np.argpartition(key, width - k, axis=1)[:, width - k:] if k < width else np.broadcast_to(np.arange(width), key.shape)
    else:
        scores[own] = low
        best = np.argsort(~scores, axis=1, kind="stable")[:, :k]        # ~x descends as -x does, the least number too
    scores[own] = low
    return np.take_along_axis(scores, best, axis=1), ids[best]


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: float, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for every row that ``is_query`` selects its
    ``k`` best other rows."""
    usable_rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    # The row numbers tell rows of one id apart; written, so that queries and candidates see the same.
    base = written(usable_rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                      weights(F.col(vector_col), scale).alias("w"), F.coalesce(is_query, F.lit(False)).alias("q")), "topk-rows")
    size = base.agg(F.count("*"), F.count_if("q")).first()
    groups = max(1, -(-int(size[1]) // QUERY_GROUP))
    parallel = base.sparkSession.sparkContext.defaultParallelism
    slices = max(4 * parallel, -(-int(size[0]) // SLICE))
    left = base.where("q").select("row", "id", "w").withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    right = base.select("row", "id", "w").withColumn("s", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int")).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(q, c):
        low = np.iinfo(np.int64).min
        qrow, crow = q.column("row").to_numpy(), c.column("row").to_numpy()
        qid, cid = q.column("id").to_numpy(), c.column("id").to_numpy()
        qw, cw = _matrix(q.column("w")), _matrix(c.column("w"))
        order = np.argsort(cid, kind="stable")
        crow, cid, cw = crow[order], cid[order], cw[order]
        score, ids = np.empty((len(qid), 0), np.int64), np.empty((len(qid), 0), np.int64)
        for at in range(0, len(cid) if len(qid) else 0, BLOCK):
            block = cid[at:at + BLOCK]
            scores = accumulate(qw, cw[at:at + BLOCK])
            own = qrow[:, None] == crow[None, at:at + BLOCK]
            picked = [select_best(scores[r:r + ROWS], block, own[r:r + ROWS], k) for r in range(0, len(qid), ROWS)]
            score = np.concatenate([score, np.concatenate([x[0] for x in picked])], axis=1)
            ids = np.concatenate([ids, np.concatenate([x[1] for x in picked])], axis=1)
            best = np.lexsort((ids, ~score), axis=1)[:, :k]
            score, ids = np.take_along_axis(score, best, axis=1), np.take_along_axis(ids, best, axis=1)
        some = score != low
        return pa.table({"row": np.broadcast_to(qrow[:, None], ids.shape)[some], "query_id": np.broadcast_to(qid[:, None], ids.shape)[some],
                         "id": ids[some], "score": score[some]})

    found = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(
        run, "row long, query_id long, id long, score long")
    w = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
