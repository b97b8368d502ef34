"""Exact top-k and nearest neighbours against brute force."""

import math

import duckdb
import numpy as np
import pytest
from compare import difference

from clickloom.llm import ann, queries, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 7) for i, v in rows], SCHEMA)


def vectors(n=600, dim=16, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, dim))
    rows = centres[draw.integers(0, 5, n)] + draw.normal(scale=0.2, size=(n, dim))
    rows[n // 3 : 2 * n // 3] = rows[0]  # a third are copies
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


ODD = [
    (1000, None), (1050, []), (1100, [None] * 16), (1150, [float("nan")] * 16), (1200, [math.inf] + [1.0] * 15),
    (None, [0.5] * 16), (1250, [0.0] * 16), (1300, [0.25, 1.0]), (1301, [0.5, -1.0]),
]


def usable(rows, zero):
    return {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))}


def brute(rows, every, k, value, zero):
    known, found = usable(rows, zero), set()
    for q in known:
        if q % every == 0:
            scores = sorted((value(known[q], v), i) for i, v in known.items() if i != q and len(v) == len(known[q]))
            found |= {(q, n + 1, i, s) for n, (s, i) in enumerate(scores[:k])}
    return found


def product(a, b):
    return -sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def distance(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += (y - x) * (y - x)
    return math.sqrt(total)


@pytest.mark.parametrize("part, stripe", [(16_384, 2_048), (150, 5)])
def test_top_products(spark, part, stripe):
    rows = vectors() + ODD
    e = table(spark, rows)
    found = topk.search(e, e.where("vec_id % 50 = 0"), 5, part=part, stripe=stripe)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = {(r.query_id, r.rank, r.vec_id, -r.score) for r in found.collect()}
    assert got == brute(rows, 50, 5, product, zero=True)


@pytest.mark.parametrize("part, stripe", [(16_384, 2_048), (150, 5)])
def test_nearest(spark, part, stripe):
    rows = vectors(seed=2) + ODD
    e = table(spark, rows)
    found = ann.search(e, e.where("vec_id % 50 = 0"), 10, part=part, stripe=stripe)
    assert {tuple(r) for r in found.collect()} == brute(rows, 50, 10, distance, zero=False)


def test_nearest_of_tiny_and_huge_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(size=8) * 10.0 ** draw.integers(-6, 7)]) for i in range(300)]
    e = table(spark, rows)
    found = ann.search(e, e.where("vec_id % 10 = 0"), 10)
    assert {tuple(r) for r in found.collect()} == brute(rows, 10, 10, distance, zero=False)


REPEATED = [(0, [1.0, 2.0]), (0, [3.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [2.0, 5.0]), (2, [0.5, 1.0])]


@pytest.mark.parametrize("name, search, every, k", [("op2_topk", topk.search, 50, 5), ("op7_ann", ann.search, 100, 10)])
@pytest.mark.parametrize("rows", [REPEATED, REPEATED * 3, vectors(150, 4) + vectors(220, 4, 9)])
def test_repeated_ids_as_in_sql(spark, tmp_path, name, search, every, k, rows):
    """Every row but those of the query's own id is a candidate."""
    path = str(tmp_path / "embeddings.parquet")
    table(spark, rows).coalesce(1).write.parquet(path)
    e = spark.read.parquet(path)
    found = search(e, e.where(f"vec_id % {every} = 0"), k, part=40, stripe=3)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/*.parquet'")
    assert difference(found, con, queries.SQL[name]) is None


@pytest.mark.parametrize("search", [topk.search, ann.search])
def test_empty_table(spark, search):
    e = table(spark, [])
    assert search(e, e, 5).count() == 0
