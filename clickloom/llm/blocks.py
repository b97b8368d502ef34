"""Searching every row for a set of queries, cell by cell of a grid of blocks.

Candidates are dealt into parts and queries into stripes, both of bounded size. A cell is
one stripe against one part: the queries are copied to every part and the candidates to
every stripe, and an equality join on the cell brings them together. So the work is
spread evenly whatever the vectors hold, and a task holds one cell at a time. Every cell
reports the best of its own for each query; those are ranked at the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a part and of a stripe, about: a cell takes some tens of MB.
PART, STRIPE = 16_384, 2_048


def usable(rows: DataFrame, vec_id: str, vector: str, zero: bool) -> DataFrame:
    """(vec_id, dim, vector) of the rows that take part: with an id, and a vector without
    null or non-finite components; zero vectors only if `zero`."""
    v = F.col(vector)
    fit = F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    fit &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero:
        fit &= F.exists(v, lambda x: x != 0)
    return rows.where(fit).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.size(v).alias("dim"), v.cast("array<double>").alias("vector")
    )


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one side of a cell in the order of ids."""
    ids = table["vec_id"].to_numpy()
    flat = table["vector"].combine_chunks()
    vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], vectors[order]


def best(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    cell: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score: str,
    largest: bool,
    part: int = PART,
    stripe: int = STRIPE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query.

    `rows` and `queries` have vec_id, dim and vector; only vectors of one length meet.
    `cell(query ids, queries, ids, vectors, k)` gives positions of queries, positions of
    candidates and scores: of each query the k best of the cell at least, without rows of
    the query's own id. Ties go to the smaller vec_id. Every row is a candidate of its own,
    also if it repeats an id; of queries of one id the best of all count.
    """
    parts = max(1, math.ceil(rows.count() / part))
    stripes = max(1, math.ceil(queries.count() / stripe))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))

    def own(n: int, name: str) -> Column:
        return (dealt % n).cast("int").alias(name)

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = queries.select("dim", own(stripes, "stripe"), every(parts, "part"), "vec_id", "vector")
    right = rows.select("dim", every(stripes, "stripe"), own(parts, "part"), "vec_id", "vector")
    key = ("dim", "stripe", "part")

    def work(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = ([], [], [])
        if queries.num_rows and rows.num_rows:
            (query_ids, q), (ids, v) = _sides(queries), _sides(rows)
            at, to, scores = cell(query_ids, q, ids, v, k)
            found = (query_ids[at], ids[to], scores)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)], ["query_id", "vec_id", "score"])

    cells = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(work, "query_id long, vec_id long, score double")
    order = F.desc("score") if largest else F.asc("score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    ranked = cells.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(score).alias("score"))


def smallest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest scores; ties go to the smaller id."""
    if len(scores) > 4 * k:
        worst = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= worst)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], scores[near]))[:k]]
