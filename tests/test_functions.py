from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from clickloom.functions import numbers, predicates, text, times


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_trim_comma_takes_one_a_side(spark):
    got = values(spark, [(",,a,",), ("a",), (",",), ("",)], "s string", text.trim_comma(F.col("s")))
    assert [g[0] for g in got] == [",a", "a", "", ""]


def test_pad_two_prefixes_whatever_is_not_two_long(spark):
    got = values(spark, [("5",), ("15",), ("123",)], "s string", text.pad_two(F.col("s")))
    assert [g[0] for g in got] == ["05", "15", "0123"]


def test_tokens_drop_trailing_empties_only(spark):
    got = values(spark, [("a,,b,,",), (",a",), ("a",)], "s string", text.tokens(F.col("s")))
    assert [g[0] for g in got] == [["a", "", "b"], ["", "a"], ["a"]]


def test_id_list(spark):
    rows = [("1,2,2",), (None,), ("",), ("3,x,,-4",), ("99999999999999999999,5",)]
    got = values(spark, rows, "s string", text.id_list(F.col("s")))
    assert [g[0] for g in got] == [[1, 2, 2], [], [], [3, -4], [5]]


@pytest.mark.parametrize(
    ("record", "value"),
    [
        ("a=1|b=2", "2"),
        ("a=1|b=", None),
        ("a=1|b=2=3", None),
        ("a=1|b=2=", "2"),
        ("a=1", None),
        ("b=1|b=2", "1"),
        ("ab=1|b=2", "2"),
    ],
)
def test_get_field(spark, record, value):
    assert values(spark, [(record,)], "s string", text.get_field(F.col("s"), "b")) == [(value,)]


def test_field_names_are_taken_as_they_are(spark):
    record = [("axb=1|a.b=2|a.b=3",)]
    assert values(spark, record, "s string", text.get_field(F.col("s"), "a.b")) == [("2",)]
    nothing = text.set_field(F.col("s"), "a.b", F.lit(None))
    assert values(spark, record, "s string", nothing) == [("axb=1|a.b=|a.b=3",)]


@pytest.mark.parametrize(
    ("record", "updated"),
    [("a=1|b=2", "a=1|b=9"), ("a=1", "a=1"), ("b=1|b=2", "b=9|b=2"), ("b=|c=3", "b=9|c=3")],
)
def test_set_field(spark, record, updated):
    assert values(spark, [(record,)], "s string", text.set_field(F.col("s"), "b", F.lit("9"))) == [(updated,)]


def test_times(spark):
    rows = [("2024-01-02 5:03:07",), ("2024-01-02 15:03:07",), ("nonsense",), (None,)]
    t = times.parse_time(F.col("s"))
    got = values(spark, rows, "s string", times.time_text(t), times.hour_key(t), times.minute_text(t))
    assert got == [
        ("2024-01-02 05:03:07", "2024-01-02_05", "202401020503"),
        ("2024-01-02 15:03:07", "2024-01-02_15", "202401021503"),
        (None, None, None),
        (None, None, None),
    ]


def test_access_log_time(spark):
    got = values(
        spark, [("17/05/2015:10:05:03",)], "s string", times.day_text(times.parse_access_time(F.col("s")))
    )
    assert got == [("2015-05-17",)]


def test_seconds_between_cuts_towards_zero(spark):
    rows = [("2024-01-01 00:00:02.9", "2024-01-01 00:00:01"), ("2024-01-01 00:00:01", "2024-01-01 00:00:02.9")]
    cols = [F.col(c).cast("timestamp") for c in ("a", "b")]
    assert values(spark, rows, "a string, b string", times.seconds_between(*cols)) == [(1,), (-1,)]


def test_today_and_yesterday(spark):
    row = spark.range(1).select((times.today().cast("date") - times.yesterday().cast("date")).alias("d")).first()
    assert row.d.days == 1


def test_ratio_is_exact_half_up(spark):
    rows = [(n, d) for d in (1, 3, 7, 8, 200, 333) for n in range(d + 1)]
    got = values(spark, rows, "n bigint, d bigint", "n", "d", numbers.ratio(F.col("n"), F.col("d")))
    for n, d, r in got:
        assert r == float((Decimal(n) / d).quantize(Decimal("0.01"), ROUND_HALF_UP)), (n, d)


def test_ratio_of_nothing(spark):
    assert values(spark, [(0, 0)], "n bigint, d bigint", numbers.ratio(F.col("n"), F.col("d"))) == [(None,)]


def test_format_double_rounds_the_binary_value(spark):
    rng = Random(1)
    xs = [0.285, 1.005, 2.675, -0.285, 0.125, -0.125, 0.0, 57 / 200, 1234.565]
    xs += [rng.randrange(100000) / 1000 for _ in range(500)] + [rng.uniform(-1000, 1000) for _ in range(200)]
    got = values(spark, [(x,) for x in xs], "x double", "x", numbers.format_double(F.col("x"), 2))
    for x, r in got:
        assert r == float(Decimal(x).quantize(Decimal("0.01"), ROUND_HALF_UP)), x


def test_predicates_that_are_not_asked_for(spark):
    c = F.col("a")
    assert predicates.between(c, 1, None) is None
    assert predicates.between(c, None, 1) is None
    assert predicates.one_of(c, None) is None
    assert predicates.equals(c, None) is None
    assert predicates.any_match(c, None) is None
    assert spark.range(3).where(predicates.all_of([None, None])).count() == 3


def test_null_data_fails_a_predicate(spark):
    df = spark.createDataFrame([(None, None), (5, "x,y")], "a int, s string")
    for p in (
        predicates.between(F.col("a"), 5, 5),
        predicates.one_of(F.col("a"), [5]),
        predicates.any_match(F.col("s"), ["q", "y"]),
    ):
        assert [r.a for r in df.where(p).collect()] == [5]
    assert df.where(predicates.any_match(F.col("s"), ["x,y"])).count() == 0
