from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import traffic
from clickloom.operators.ranking import top_n


def events(spark, rows):
    return spark.createDataFrame(rows, "key string, ms bigint").select("key", F.timestamp_millis("ms").alias("ts"))


@pytest.mark.parametrize(
    ("length", "slide"), [(60, 5), (60, 60), (60, 25), (10, 25), (7, 3)], ids=lambda v: str(v)
)
def test_counts_like_one_window_at_a_time(spark, length, slide):
    rng = Random(length * slide)
    rows = [(rng.choice("aaab"), rng.randrange(-300, 600)) for _ in range(300)]
    expected = Counter(
        (start + length, key)
        for key, ms in rows
        for start in range(-1200, 1200, 1)
        if start % slide == 0 and start <= ms < start + length
    )
    got = traffic.sliding_counts(events(spark, rows), "key", length, slide).collect()
    assert {(r.window_end, r.key): r["count"] for r in got} == dict(expected)


def test_top_n_breaks_ties_by_key_and_takes_short_groups(spark):
    counts = spark.createDataFrame(
        [(1, "c", 5), (1, "a", 5), (1, "b", 7), (1, "d", 5), (2, "x", 1)], "window_end bigint, key string, count bigint"
    )
    got = [(r.window_end, r["rank"], r.key) for r in traffic.rank_windows(counts, "key", 3).collect()]
    assert sorted(got) == [(1, 1, "b"), (1, 2, "a"), (1, 3, "c"), (2, 1, "x")]


def test_sort_key_order(spark):
    df = spark.createDataFrame([(1, 30, 45, 20), (2, 35, 50, 4), (3, 30, 44, 21)], "id int, a int, b int, c int")
    assert [r.id for r in top_n(df, 3, [F.desc("a"), F.desc("b"), F.desc("c"), "id"]).collect()] == [2, 1, 3]


def test_report(spark):
    ranked = spark.createDataFrame(
        [(1511658300000, 7, 9, 1), (1511658300000, 5, 3, 2)],
        "window_end bigint, item_id bigint, count bigint, rank int",
    )
    (row,) = traffic.report(ranked, "item_id", traffic.ITEM_LABELS, traffic.ITEM_RULERS).collect()
    assert row.report.split("\n") == [
        "=" * 40, "时间: 2017-11-26 01:05:00.0", "No1: 商品ID=7 浏览量=9", "No2: 商品ID=5 浏览量=3", "=" * 29, "", "",
    ]
