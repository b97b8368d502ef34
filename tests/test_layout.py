"""Actions as a table by date and session: the same rows, without a shuffle."""

from uuid import uuid4

import pytest
from test_rollups import rows_of, some_actions

from clickloom.operators import sessions
from clickloom.sources.layout import ActionTable
from clickloom.sources.tables import actions_between
from clickloom.sources.tasks import TaskParams

RANGE = TaskParams(start_date="2024-01-02", end_date="2024-01-04", keywords=("tea",))


@pytest.fixture
def stored(spark, tmp_path):
    made = []

    def store(actions, buckets=5):
        made.append(ActionTable(spark, f"actions_{uuid4().hex}", str(tmp_path), buckets).save(actions))
        return made[-1]

    yield store
    for table in made:
        table.drop()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("params", [TaskParams(), RANGE])
def test_the_same_sessions_and_actions(spark, stored, params):
    actions = some_actions(spark, 11).persist()
    table, ranged = stored(actions), actions_between(actions, params.start_date, params.end_date)
    assert rows_of(table.actions(params)) == rows_of(ranged)
    assert rows_of(table.rollup(params, lists=True)) == rows_of(sessions.rollup(ranged, params, lists=True))
    chosen = spark.createDataFrame([("s0",), ("s3",), ("s3",), ("none",), (None,)], "session_id string")
    assert rows_of(table.actions_of(chosen, params)) == rows_of(sessions.actions_of(ranged, chosen))


def test_long_sessions_and_rows_of_none_lie_apart(spark, stored):
    actions = some_actions(spark, 13)
    common, hot = stored(actions).parts()
    assert {r.session_id for r in hot.select("session_id").distinct().collect()} == {"s0", None}
    assert common.where("session_id = 's0' or session_id is null").count() == 0
    sizes = [r["count"] for r in common.groupBy("session_id").count().collect()]
    assert max(sizes) <= 600 // 5


def test_no_shuffle_of_the_actions(spark, stored, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    table = stored(some_actions(spark, 17))
    common, _ = table.parts(RANGE.start_date, RANGE.end_date)
    rollup = plan_of(sessions.rollup(common, RANGE))
    assert "Exchange" not in rollup and "PartitionFilters: [isnotnull(date" in rollup
    chosen = sessions.rollup(common, RANGE).where("keyword_hit")
    kept = plan_of(sessions.actions_of(common, chosen))
    assert "SortMergeJoin" in kept and "Exchange" not in kept


def test_saving_again_replaces(spark, stored):
    table = stored(some_actions(spark, 19))
    fewer = some_actions(spark, 23, n=50)
    table.save(fewer)
    assert rows_of(table.actions()) == rows_of(fewer)


def test_no_rows_and_one_row(spark, stored):
    actions = some_actions(spark, 29, n=1)
    assert stored(actions.limit(0)).rollup().count() == 0
    assert rows_of(stored(actions).actions()) == rows_of(actions)
