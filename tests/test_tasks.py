from pyspark.sql import functions as F

from clickloom.sources.tasks import TaskParams, first_param, load_params, param_columns


def test_params_take_the_first_element():
    got = TaskParams.from_json(
        '{"startDate": ["2024-01-01", "x"], "startAge": ["10"], "endAge": [50], "cities": [],'
        ' "professionals": ["a,b"], "categoryIds": ["1, 2"]}'
    )
    assert got == TaskParams(
        start_date="2024-01-01", start_age=10, end_age=50, professionals=("a", "b"), category_ids=("1", " 2")
    )


def test_no_params():
    assert TaskParams.from_json("{}") == TaskParams() == TaskParams.from_json("")


def test_task_lookup(spark):
    tasks = spark.createDataFrame([(1, '{"sex": ["male"]}'), (2, None)], "task_id bigint, task_param string")
    assert load_params(tasks, 1) == TaskParams(sex="male")
    assert load_params(tasks, 2) == TaskParams()
    assert load_params(tasks, 3) is None
    assert [(r.task_id, r.sex) for r in param_columns(tasks).collect()] == [(1, "male"), (2, None)]


def test_first_param(spark):
    df = spark.createDataFrame([('{"a": []}',), ('{"a": ["x", "y"]}',), ("{}",)], "j string")
    assert [r[0] for r in df.select(first_param(F.col("j"), "a")).collect()] == [None, "x", None]
