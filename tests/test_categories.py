from collections import Counter, defaultdict
from random import Random

import pytest
from pyspark.sql import functions as F
from test_sessions import action, actions

from clickloom.operators import categories, sampling, sessions


@pytest.fixture(scope="module")
def skewed():
    """Session `hot` holds half of all actions, category 7 most of the clicks."""
    rng = Random(5)
    rows = []
    for i in range(1500):
        session = "hot" if i % 2 else f"s{rng.randrange(40)}"
        category = 7 if rng.random() < 0.5 else rng.randrange(25)
        kind = rng.choice(["click", "order", "pay", "search"])
        cols = {
            "click": {"click_category_id": category},
            "order": {"order_category_ids": f"{category},,{rng.randrange(25)},x"},
            "pay": {"pay_category_ids": f"{category}"},
            "search": {"search_keyword": "tea"},
        }[kind]
        rows.append(action(1, session, f"2024-01-0{1 + i % 3} {i % 24}:00:00", **cols))
    return rows


def touches_of(rows):
    for row in rows:
        session, click, orders, pays = row[2], row[6], row[8], row[10]
        if click is not None:
            yield session, "click", click
        for kind, ids in (("order", orders), ("pay", pays)):
            for token in (ids or "").split(","):
                if token.isdigit():
                    yield session, kind, int(token)


def test_counts_and_rankings(spark, skewed):
    counts = defaultdict(Counter)
    clicks = Counter()
    for session, kind, category in touches_of(skewed):
        counts[category][kind] += 1
        clicks[category, session] += kind == "click"
    order = sorted(counts, key=lambda c: (-counts[c]["click"], -counts[c]["order"], -counts[c]["pay"], c))[:10]

    pairs = categories.session_category_counts(actions(spark, skewed))
    totals = categories.category_counts(pairs)
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in totals.collect()}
    assert got == {c: (n["click"], n["order"], n["pay"]) for c, n in counts.items()}

    top = categories.top_categories(totals)
    assert [r.category_id for r in top.collect()] == order

    ranked = categories.top_sessions(categories.category_session_clicks(pairs), top, n=3)
    expected = set()
    for c in order:
        best = sorted((-n, s) for (cat, s), n in clicks.items() if cat == c and n)[:3]
        expected |= {(c, s, -n, rank + 1) for rank, (n, s) in enumerate(best)}
    assert {(r.category_id, r.session_id, r.click_count, r["rank"]) for r in ranked.collect()} == expected


def test_touched(spark, skewed):
    got = [r.category_id for r in categories.touched(actions(spark, skewed)).collect()]
    assert sorted(got) == sorted({c for _, _, c in touches_of(skewed)})


def test_fewer_categories_than_asked_for(spark):
    pairs = categories.session_category_counts(
        actions(spark, [action(1, "a", "2024-01-01 05:00:00", click_category_id=3)])
    )
    assert categories.top_categories(categories.category_counts(pairs)).count() == 1


def sample_input(spark, per_hour):
    rows = [(f"{d}-{h}-{i}", f"2024-01-{d:02} {h:02}:00:00") for (d, h), n in per_hour.items() for i in range(n)]
    return spark.createDataFrame(rows, "session_id string, t string").select(
        "session_id", F.col("t").cast("timestamp").alias("start_time")
    )


def test_quotas_and_draw(spark):
    per_hour = {(1, 0): 300, (1, 5): 100, (1, 6): 1, (2, 3): 2, (2, 4): 2}
    chosen = sample_input(spark, per_hour)
    quotas = {(r.date[-1], int(r.hour)): r.quota for r in sampling.quotas(sampling.hour_counts(chosen), 100).collect()}
    # 50 a day: 300/401 and 100/401 of it cut down, a share of 1/401 is nothing; small hours are capped.
    assert quotas == {("1", 0): 37, ("1", 5): 12, ("2", 3): 2, ("2", 4): 2}
    drawn = sampling.sample_sessions(chosen, 100, seed=1)
    got = Counter((r.date[-1], int(r.hour)) for r in drawn.collect())
    assert got == quotas
    again = {r.session_id for r in sampling.sample_sessions(chosen.repartition(7), 100, seed=1).collect()}
    assert again == {r.session_id for r in drawn.collect()}
    other = {r.session_id for r in sampling.sample_sessions(chosen, 100, seed=2).collect()}
    assert other != again


def test_more_days_than_sample(spark):
    chosen = sample_input(spark, {(d, 0): 3 for d in range(1, 12)})
    assert sampling.sample_sessions(chosen, 10).count() == 0


def test_details_of_sample(spark, skewed):
    df = actions(spark, skewed)
    sample = sampling.sample_sessions(sessions.rollup(df), 1000)
    kept = sampling.sample_actions(df, sample, 1000)
    chosen = {r.session_id for r in sample.collect()}
    assert kept.count() == sum(r[2] in chosen for r in skewed)
    assert {r.session_id for r in sampling.sample_report(kept, 1).collect()} == chosen


def test_nothing_to_sample(spark):
    assert sampling.sample_sessions(sample_input(spark, {(1, 0): 1}).where("false")).count() == 0
