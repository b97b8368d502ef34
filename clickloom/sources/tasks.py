"""Task rows and their JSON parameters."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The keys of a task's JSON parameters, by our field name.
PARAM_KEYS = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
}


@dataclass(frozen=True)
class TaskParams:
    """What a task asks for. None means: not asked, so not filtered."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None

    @classmethod
    def from_json(cls, text: str) -> TaskParams:
        """Each key maps to an array whose first element counts; lists are comma lists in it."""
        raw = json.loads(text or "{}")
        firsts = {name: str(raw[key][0]) for name, key in PARAM_KEYS.items() if raw.get(key)}
        for name in ("start_age", "end_age"):
            if name in firsts:
                firsts[name] = int(firsts[name])
        for name in ("professionals", "cities", "keywords", "category_ids"):
            if name in firsts:
                firsts[name] = tuple(firsts[name].split(","))
        return cls(**firsts)


def first_param(col: Column, key: str) -> Column:
    """First element of a key's array as text, null if the key or the element is missing."""
    return F.get_json_object(col, f"$.{key}[0]")


def param_columns(tasks: DataFrame) -> DataFrame:
    """Task rows with one column per parameter."""
    return tasks.select(
        "task_id", *[first_param(F.col("task_param"), key).alias(name) for name, key in PARAM_KEYS.items()]
    )


def tasks_over_jdbc(spark: SparkSession, url: str, task_id: int, table: str = "task", **options: str) -> DataFrame:
    """The row of one task; the database applies the predicate."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    return reader.load().where(F.col("task_id") == task_id)


def load_params(tasks: DataFrame, task_id: int) -> TaskParams | None:
    """Parameters of one task, None if there is no such task. Fetches that one row; of
    several the first by its text."""
    rows = tasks.where(F.col("task_id") == task_id).select("task_param").orderBy("task_param").limit(1).collect()
    return TaskParams.from_json(rows[0][0]) if rows else None


assert set(PARAM_KEYS) == {f.name for f in fields(TaskParams)}
