"""Nearest neighbours by a block matrix join of int8 vectors.

Every vector is rounded to int8 steps of its own; what rounding took away has a known
length. A tile of int8 products gives the distances of the rounded vectors, and by the
triangle inequality the true distance lies within the sum of the two rounding errors.
Candidates whose least possible distance exceeds the k-th smallest greatest possible one
are dropped; the others are computed from the original vectors in double precision and
merged, tile by tile, into the heap of the query's k nearest so far, whose farthest is the
limit for the next tile. Nothing that could be among the nearest is dropped, so the
result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame

from clickloom.llm import blocks

QUERIES, TILE = 256, 4_096


def _rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their steps, the lengths of the rounded vectors squared and of what
    rounding took away (with room for floating-point error)."""
    steps = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / np.where(steps > 0, steps, 1)[:, None]).astype(np.int8)
    near = codes * steps[:, None]
    lost = np.sqrt(((vectors - near) ** 2).sum(axis=1))
    lengths = (near**2).sum(axis=1)
    return codes, steps, lengths, lost * (1 + 1e-9) + 1e-7 * np.sqrt(lengths)


def _distance(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed component by component."""
    total = np.zeros(len(vectors))
    for d in range(len(query)):
        total += (vectors[:, d] - query[d]) ** 2
    return np.sqrt(total)


def _cell(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    codes, steps, lengths, lost = _rounded(vectors)
    q_codes, q_steps, q_lengths, q_lost = _rounded(queries)
    at, to, scores = [], [], []
    for first in range(0, len(queries), QUERIES):
        rows = slice(first, first + QUERIES)
        count = len(query_ids[rows])
        # The k nearest so far of each query, the farthest first: (-distance, -id, place).
        heaps: list[list[tuple]] = [[] for _ in range(count)]
        for start in range(0, len(vectors), TILE):
            tile = slice(start, start + TILE)
            # Sums of up to 1,000 int8 products are exact in float32.
            kind = np.float32 if vectors.shape[1] <= 1000 else np.float64
            products = q_codes[rows].astype(kind) @ codes[tile].astype(kind).T
            squares = q_lengths[rows, None] + lengths[None, tile] - 2 * products * q_steps[rows, None] * steps[None, tile]
            middle = np.sqrt(np.maximum(squares, 0))
            room = q_lost[rows, None] + lost[None, tile] + 1e-7 * np.sqrt(q_lengths[rows, None] + lengths[None, tile])
            lower, upper = middle - room, middle + room
            own = query_ids[rows, None] == ids[None, tile]
            lower[own] = upper[own] = np.inf
            for row, heap in enumerate(heaps):
                limit = -heap[0][0] if len(heap) == k else np.inf
                near = np.flatnonzero((lower[row] <= limit) & ~own[row])
                if len(near) > k:
                    near = near[lower[row, near] <= np.partition(upper[row, near], k - 1)[k - 1]]
                if not len(near):
                    continue
                exact = _distance(queries[first + row], vectors[near + start])
                for place in blocks.smallest(exact, ids[near + start], k).tolist():
                    found = (-float(exact[place]), -int(ids[near[place] + start]), int(near[place]) + start)
                    if len(heap) < k:
                        heapq.heappush(heap, found)
                    elif found[:2] > heap[0][:2]:
                        heapq.heapreplace(heap, found)
        for row, heap in enumerate(heaps):
            at += [first + row] * len(heap)
            to += [place for _, _, place in heap]
            scores += [-far for far, _, _ in heap]
    return np.array(at, int), np.array(to, int), np.array(scores, float)


def search(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    part: int = blocks.PART,
    stripe: int = blocks.STRIPE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the k nearest rows of
    `embeddings` by Euclidean distance, other than the query's own id, all if there are
    fewer; ties go to the smaller vec_id.

    Rows without an id, and vectors that are null, empty, zero or hold null or non-finite
    components take no part. Only vectors of one length are compared. Rows that repeat an id are
    candidates each; queries of one id are answered as one, with the best of all. Other columns are ignored.
    """
    rows = blocks.usable(embeddings, vec_id, vector, zero=False)
    wanted = blocks.usable(queries, vec_id, vector, zero=False)
    return blocks.best(rows, wanted, k, _cell, "double", False, part, stripe)
