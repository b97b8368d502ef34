from datetime import datetime, timedelta

import pytest

from clickloom import schemas
from clickloom.operators import sessions
from clickloom.sources.tables import actions_between
from clickloom.sources.tasks import TaskParams

START = datetime(2024, 1, 1, 5, 3, 7)


def action(user, session, at, date="2024-01-01", **cols):
    names = [c.split()[0] for c in schemas.ACTIONS.split(",")]
    row = dict.fromkeys(names) | {"date": date, "user_id": user, "session_id": session, "action_time": at} | cols
    return tuple(row[n] for n in names)


def actions(spark, rows):
    return spark.createDataFrame(rows, schemas.ACTIONS)


def users(spark, *ids):
    rows = [(i, f"u{i}", f"n{i}", 20 + i, f"p{i % 2}", f"c{i}", "male" if i % 2 else "female") for i in ids]
    return spark.createDataFrame(rows, schemas.USERS)


def test_rollup(spark):
    rows = [
        action(1, "a", "2024-01-01 5:03:07", search_keyword="1"),
        action(1, "a", "2024-01-01 15:03:08", search_keyword="11"),
        action(1, "a", "2024-01-01 6:00:00", click_category_id=11),
        action(1, "a", "2024-01-01 6:00:00", click_category_id=1),
        action(1, "a", "2024-01-01 6:00:00", search_keyword=""),
        action(1, None, "2024-01-01 6:00:00"),
    ]
    (row,) = sessions.rollup(actions(spark, rows), lists=True).collect()
    assert (row.session_id, row.user_id, row.step_length, row.visit_length) == ("a", 1, 5, 36001)
    assert (row.search_keywords, row.click_category_ids) == ("1,11", "1,11")
    assert row.start_time == START


def test_unknown_users_vanish(spark):
    rows = [action(1, "a", "2024-01-01 05:00:00"), action(9, "b", "2024-01-01 05:00:00")]
    got = sessions.select_sessions(actions(spark, rows), users(spark, 1, 2), TaskParams()).collect()
    assert [r.session_id for r in got] == ["a"]


@pytest.mark.parametrize(
    ("params", "kept"),
    [
        (TaskParams(), "abc"),
        (TaskParams(start_age=21), "abc"),
        (TaskParams(start_age=22, end_age=23), "bc"),
        (TaskParams(professionals=("p1",)), "ac"),
        (TaskParams(cities=("c1", "c2")), "ab"),
        (TaskParams(sex="male"), "ac"),
        (TaskParams(keywords=("tea", "milk")), "a"),
        (TaskParams(category_ids=("7",)), "b"),
        (TaskParams(keywords=("tea",), category_ids=("7",)), ""),
        (TaskParams(sex="male", keywords=("tea",)), "a"),
    ],
)
def test_filters(spark, params, kept):
    rows = [
        action(1, "a", "2024-01-01 05:00:00", search_keyword="tea"),
        action(1, "a", "2024-01-01 05:00:01", click_category_id=77),
        action(2, "b", "2024-01-01 05:00:00", click_category_id=7),
        action(3, "c", "2024-01-01 05:00:00"),
    ]
    got = sessions.select_sessions(actions(spark, rows), users(spark, 1, 2, 3), params).collect()
    assert "".join(sorted(r.session_id for r in got)) == kept


def test_date_range_is_inclusive_and_open(spark):
    rows = [action(1, f"s{d}", f"2024-01-0{d} 05:00:00", date=f"2024-01-0{d}") for d in range(1, 6)]
    df = actions(spark, rows)
    days = lambda *range_: sorted(r.date[-1] for r in actions_between(df, *range_).collect())
    assert days("2024-01-02", "2024-01-03") == ["2", "3"]
    assert days("2024-01-04") == ["4", "5"]
    assert days(None, "2024-01-02") == ["1", "2"]


@pytest.mark.parametrize(
    ("seconds", "bucket"),
    [
        (0, None), (1, "1s_3s"), (3, "1s_3s"), (4, "4s_6s"), (6, "4s_6s"), (7, "7s_9s"), (9, "7s_9s"),
        (10, "10s_30s"), (30, "10s_30s"), (31, "30s_60s"), (60, "30s_60s"), (61, "1m_3m"), (180, "1m_3m"),
        (181, "3m_10m"), (600, "3m_10m"), (601, "10m_30m"), (1800, "10m_30m"), (1801, "30m"),
    ],
)
def test_visit_buckets(spark, seconds, bucket):
    ends = [START, START + timedelta(seconds=seconds)]
    rolled = sessions.rollup(actions(spark, [action(1, "a", str(t)) for t in ends]))
    (row,) = sessions.length_counts(rolled).collect()
    hit = [n for n in sessions.VISIT_BUCKETS if row[n]]
    assert hit == ([] if bucket is None else [f"visit_length_{bucket}"])


@pytest.mark.parametrize(
    ("steps", "bucket"), [(1, "1_3"), (3, "1_3"), (4, "4_6"), (9, "7_9"), (10, "10_30"), (31, "30_60"), (61, "60")]
)
def test_step_buckets(spark, steps, bucket):
    rolled = sessions.rollup(actions(spark, [action(1, "a", str(START))] * steps))
    (row,) = sessions.length_counts(rolled).collect()
    assert [n for n in sessions.STEP_BUCKETS if row[n]] == [f"step_length_{bucket}"]


def test_no_sessions_give_no_ratios(spark):
    (row,) = sessions.length_stats(sessions.rollup(actions(spark, [])), 1).collect()
    assert row.session_count == 0
    assert row.step_length_1_3_ratio is None


def test_details_keep_the_time_as_written(spark):
    df = sessions.details(actions(spark, [action(1, "a", "2024-01-01 5:03:07", page_id=4)]), 8, "top")
    row = df.first()
    assert (row.task_id, row.source, row.action_time, row.page_id) == (8, "top", "2024-01-01 5:03:07", 4)
