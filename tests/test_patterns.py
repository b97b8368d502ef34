from random import Random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import patterns
from clickloom.operators.nearest import borders, in_pieces, nearest

LOGINS = "user_id bigint, ip string, event_type string, us bigint, seq bigint"
ORDERS = "order_id bigint, event_type string, us bigint, seq bigint"
S = patterns.SECOND


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def simulate_bursts(rows, limit):
    """Pending list and timers, one user at a time."""
    found = []
    for user in {r[0] for r in rows}:
        fails = [r for r in rows if r[0] == user and r[2] == "fail"]
        steps = sorted([(r[3], 0, r[4], r) for r in fails] + [(r[3] + limit, 1, r[4], None) for r in fails])
        pending = []
        for _, is_timer, _, row in steps:
            if not is_timer:
                pending.append(row)
                continue
            if len(pending) > 1:
                found.append((user, pending[0][1], pending[0][3], pending[0][4], len(pending)))
            pending = []
    return sorted(found)


def simulate_pairs(rows, limit):
    found, last = [], {}
    for user, ip, kind, us, seq in sorted(rows, key=lambda r: (r[0], r[3], r[4])):
        before = last.get(user)
        if before and kind == before[2] == "fail" and us - before[3] < limit:
            found.append((user, before[1], ip, us, seq))
        last[user] = (user, ip, kind, us, seq)
    return sorted(found)


def simulate_orders(rows, limit):
    found, open_creates = [], {}
    for order, kind, us, seq in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        waiting = open_creates.setdefault(order, [])
        if kind == "create":
            waiting.append((us, seq))
        else:
            for at, n in waiting:
                ok = us - at < limit
                found.append((order, at, n, "success" if ok else "timeout", us if ok else None))
            waiting.clear()
    for order, waiting in open_creates.items():
        found += [(order, at, n, "timeout", None) for at, n in waiting]
    return sorted(found, key=str)


def random_logins(seed, span, n=400, users=4):
    """A third and more of the rows belong to user 0; many share an instant."""
    rng = Random(seed)
    return [
        (
            0 if rng.random() < 0.4 else rng.randrange(users),
            f"ip{i}",
            "fail" if rng.random() < 0.7 else "success",
            rng.randrange(span),
            i,
        )
        for i in range(n)
    ]


# With pieces of 20 rows every user is cut.
CASES = [
    (seed, limit, span, piece_rows)
    for seed in range(2)
    for limit, span in ((10, 1500), (7, 300), (50, 4000))
    for piece_rows in (20, 10**6)
]


@pytest.mark.parametrize(("seed", "limit", "span", "piece_rows"), CASES)
def test_bursts_like_timers(spark, seed, limit, span, piece_rows):
    rows = random_logins(seed, span)
    expected = simulate_bursts(rows, limit)
    assert len(expected) > 3
    assert rows_of(patterns.login_bursts(spark.createDataFrame(rows, LOGINS), limit, piece_rows)) == expected


@pytest.mark.parametrize(("seed", "limit", "span", "piece_rows"), CASES)
def test_pairs_like_a_walk(spark, seed, limit, span, piece_rows):
    rows = random_logins(seed, span)
    expected = simulate_pairs(rows, limit)
    assert len(expected) > 3
    assert rows_of(patterns.login_pairs(spark.createDataFrame(rows, LOGINS), limit, piece_rows)) == expected


@pytest.mark.parametrize(("seed", "limit", "span", "piece_rows"), CASES)
def test_orders_like_a_walk(spark, seed, limit, span, piece_rows):
    rows = [(u, "create" if k == "fail" else "pay", us, seq) for u, _, k, us, seq in random_logins(seed, span)]
    got = patterns.order_outcomes(spark.createDataFrame(rows, ORDERS), limit, piece_rows).collect()
    assert sorted((tuple(r) for r in got), key=str) == simulate_orders(rows, limit)


@pytest.mark.parametrize(("gap", "status"), [(0, "success"), (9, "success"), (10, "timeout")])
def test_the_limit_itself_is_too_late(spark, gap, status):
    orders = spark.createDataFrame([(1, "create", 100, 1), (1, "pay", 100 + gap, 2)], ORDERS)
    assert [r.status for r in patterns.order_outcomes(orders, 10).collect()] == [status]


def test_a_pay_without_create_says_nothing(spark):
    orders = spark.createDataFrame([(1, "pay", 100, 1), (None, "create", 100, 2), (2, "other", 1, 3)], ORDERS)
    assert patterns.order_outcomes(orders, 10).count() == 0


SHAPES = {
    "spread": "id",
    "a minute of a year": f"if(id % 100 < 99, id % 60 * {S}, id * {1000 * S})",
    "one instant": "cast(5 as bigint)",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_pieces_are_even_however_a_key_lies_in_time(spark, shape):
    """A third of the rows belongs to one user, in pieces of about a hundredth of all rows."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"), F.expr(SHAPES[shape]).alias("us"), F.col("id").alias("seq")
    )
    order = [F.col("us"), F.col("seq")]
    cuts = borders(rows, "user_id", order, 60_000, 100)
    hot = cuts.where("user_id = 0").count()
    assert 20 <= hot <= 50 and cuts.count() <= 101
    started = in_pieces(rows, cuts, "user_id", order, 100).where("user_id = 0 and split")
    sizes = [r["count"] for r in started.groupBy("piece").count().collect()]
    assert len(sizes) > hot - 5 and sum(sizes) == 20_000 and max(sizes) < 2_400


@pytest.mark.parametrize("pieces", [1, 31, 32, 33, 1100])
def test_the_tree_finds_what_counting_finds(spark, pieces):
    """More borders than the tree was laid out for, repeated ones, and keys without any."""
    rng = Random(pieces)
    places = sorted(rng.randrange(3000) for _ in range(1500))
    cuts = spark.createDataFrame([(0, i, (at, 0)) for i, at in enumerate(places, 1)], "k int, nth int, cut struct<o0: int, o1: int>")
    rows = [(k, rng.randrange(-5, 3005), rng.randrange(-1, 2)) for k in (0, 0, 0, 1) for _ in range(200)]
    found = in_pieces(spark.createDataFrame(rows, "k int, at int, seq int"), cuts, "k", [F.col("at"), F.col("seq")], pieces)
    for r in found.collect():
        assert r.piece == (0 if r.k else sum((at, 0) <= (r["at"], r.seq) for at in places)) and r.split == (r.k == 0)


def test_every_piece_knows_what_came_before(spark):
    rows = spark.range(5_000).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 1700 == 3, F.col("id")).alias("v"))
    found = nearest(rows, "k", [F.col("at")], F.col("v"), piece_rows=50).collect()
    assert len(found) == 5_000
    for r in found:
        before = [v for v in (3, 1703, 3403) if v < r["at"]]
        assert r.near == (before[-1] if before else None)


@pytest.mark.parametrize("shape", ["spread", "one instant"])
def test_a_hot_user_like_any_other(spark, shape):
    """Half of all rows belongs to one user; cut into pieces or not, the result is the same."""
    span = 3000 if shape == "spread" else 1
    rng = Random(9)
    rows = [(0, f"ip{i}", rng.choice("fs"), rng.randrange(span), i) for i in range(1000)]
    rows += [(i, f"ip{i}", "f", rng.randrange(3000), i) for i in range(1, 1001)]
    rows = [(u, ip, {"f": "fail", "s": "success"}[k], us, seq) for u, ip, k, us, seq in rows]
    logins = spark.createDataFrame(rows, LOGINS)
    assert rows_of(patterns.login_bursts(logins, 20, piece_rows=20)) == simulate_bursts(rows, 20)
    assert rows_of(patterns.login_pairs(logins, 20, piece_rows=20)) == simulate_pairs(rows, 20)
    events = [(u, "create" if k == "fail" else "pay", us, seq) for u, _, k, us, seq in rows]
    got = patterns.order_outcomes(spark.createDataFrame(events, ORDERS), 20, piece_rows=20).collect()
    assert sorted((tuple(r) for r in got), key=str) == simulate_orders(events, 20)
