"""Exact search for the largest integer inner products, by statistics of segments.

Every component becomes floor(scale * x). Vectors are cut into segments, coarse ones
first, each cut in two for the next resolution. For a segment of n components with means
m, M and deviations s, S of query and candidate, the squared distance is at least
n * ((m - M)^2 + (s - S)^2). As |q - c|^2 = |q|^2 + |c|^2 - 2 q.c, a lower bound of the
distance is an upper bound of the product. Candidates whose bound is below the k-th
largest product known are dropped, resolution by resolution; products of the survivors
are computed in whole numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import blocks

SCALE = 256
#: Segments of the first resolution, and of the last at most.
COARSE, FINE = 4, 16
QUERIES = 64


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Of each segment its mean and deviation times the root of its length, so that the
    squared distance of two such rows is the lower bound of the squared distance."""
    columns = []
    for segment in np.array_split(vectors, segments, axis=1):
        root = np.sqrt(segment.shape[1])
        columns += [segment.mean(axis=1) * root, segment.std(axis=1) * root]
    return np.stack(columns, axis=1)


def _cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    dim = vectors.shape[1]
    levels = []
    while (segments := min(dim, COARSE << len(levels))) <= FINE and (not levels or segments > levels[-1]):
        levels.append(segments)
    known = [(_statistics(queries, n), _statistics(vectors, n)) for n in levels]
    norms = (vectors * vectors).sum(axis=1)
    at, to, scores = [], [], []
    for first in range(0, len(queries), QUERIES):
        block = slice(first, first + QUERIES)
        q, own = queries[block], query_ids[block]
        squares = (q * q).sum(axis=1)
        # Twice the product is at most |q|^2 + |c|^2 less the bound; rounding is allowed for.
        total = squares[:, None] + norms[None, :]
        slack = 1e-9 * total + 1e-6

        def bound(level: int, rows: int, columns=slice(None)) -> np.ndarray:
            mine, theirs = known[level][0][block][rows], known[level][1][columns]
            far = ((theirs - mine) ** 2).sum(axis=1)
            return (total[rows, columns] - far + slack[rows, columns]) / 2

        mine, theirs = known[0][0][block], known[0][1]
        far = (mine**2).sum(axis=1)[:, None] + (theirs**2).sum(axis=1)[None, :] - 2 * mine @ theirs.T
        coarse = (total - far + slack) / 2
        for row in range(len(q)):
            others = ids != own[row]
            n = min(k, int(others.sum()))
            if not n:
                continue
            upper = np.where(others, coarse[row], -np.inf)
            # The most promising candidates give the first threshold.
            start = np.argpartition(upper, -min(len(upper), 8 * n))[-min(len(upper), 8 * n) :]
            start = start[others[start]]
            threshold = np.partition(vectors[start] @ q[row], len(start) - n)[len(start) - n]
            left = np.flatnonzero(upper >= threshold)
            for level in range(1, len(levels)):
                left = left[bound(level, row, left) >= threshold]
            product = vectors[left] @ q[row]
            kept = left[blocks.smallest(-product, ids[left], n)]
            at.append(np.full(len(kept), first + row))
            to.append(kept)
            scores.append(vectors[kept] @ q[row])
    if not at:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(at), np.concatenate(to), np.concatenate(scores)


def search(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    part: int = blocks.PART,
    stripe: int = blocks.STRIPE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k rows of `embeddings`
    with the largest inner product of the vectors floor(scale * x), other than the query's
    own id, all if there are fewer; exact, ties to the smaller vec_id.

    Rows without an id, and vectors that are null, empty or hold null or non-finite
    components take no part. Only vectors of one length are compared. Rows that repeat an id are
    candidates each; queries of one id are answered as one, with the best of all. Other columns are ignored. Products are exact as
    long as they stay below 2^53.
    """

    def whole(rows: DataFrame) -> DataFrame:
        return blocks.usable(rows, vec_id, vector, zero=True).withColumn(
            "vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double"))
        )

    return blocks.best(whole(embeddings), whole(queries), k, _cell, "long", True, part, stripe)
