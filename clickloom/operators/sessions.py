"""Sessions: rollup of actions, user attributes, optional filters, length statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import numbers, predicates, text, times
from clickloom.sources.tasks import TaskParams

# Inclusive bucket borders of visit length (seconds) and step length
# (actions), with the column names of the result. A visit of 0 seconds is in no bucket.
VISIT_BUCKETS = {
    "visit_length_1s_3s": (1, 3),
    "visit_length_4s_6s": (4, 6),
    "visit_length_7s_9s": (7, 9),
    "visit_length_10s_30s": (10, 30),
    "visit_length_30s_60s": (31, 60),
    "visit_length_1m_3m": (61, 180),
    "visit_length_3m_10m": (181, 600),
    "visit_length_10m_30m": (601, 1800),
    "visit_length_30m": (1801, None),
}
STEP_BUCKETS = {
    "step_length_1_3": (1, 3),
    "step_length_4_6": (4, 6),
    "step_length_7_9": (7, 9),
    "step_length_10_30": (10, 30),
    "step_length_30_60": (31, 60),
    "step_length_60": (61, None),
}


def rollup(actions: DataFrame, params: TaskParams | None = None, lists: bool = False) -> DataFrame:
    """One row per session: user, first and last time, visit length, step length.

    `lists` adds the distinct keywords and clicked categories; only a report that
    shows them should pay for it. A filter on them does not need them: `params`
    turns it into two flags, so the aggregate keeps fixed-size buffers and combines
    before the shuffle however long a session is. Rows without a session id belong
    to no session.
    """
    params = params or TaskParams()
    marks = {
        "keyword_hit": predicates.any_match(F.col("search_keyword"), params.keywords),
        "category_hit": predicates.one_of(F.col("click_category_id").cast("string"), params.category_ids),
    }
    aggregates = [
        F.min("user_id").alias("user_id"),
        F.min("_time").alias("start_time"),
        F.max("_time").alias("end_time"),
        F.count("*").alias("step_length"),
    ]
    aggregates += [F.bool_or(F.coalesce(m, F.lit(False))).alias(name) for name, m in marks.items() if m is not None]
    if lists:
        aggregates += [
            text.joined_set(F.when(text.is_not_empty(F.col("search_keyword")), F.col("search_keyword"))).alias(
                "search_keywords"
            ),
            text.joined_set(F.col("click_category_id")).alias("click_category_ids"),
        ]
    return (
        actions.where(F.col("session_id").isNotNull())
        .withColumn("_time", times.as_timestamp(actions, "action_time"))
        .groupBy("session_id")
        .agg(*aggregates)
        .withColumn("visit_length", times.seconds_between(F.col("end_time"), F.col("start_time")))
    )


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add age, professional, city and sex; sessions of unknown users vanish.

    No hint: the planner broadcasts the users when their size allows it, and
    otherwise splits a user with very many sessions at run time (skew join).
    """
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")


def user_filter(params: TaskParams) -> Column:
    """The part of the filter that user attributes decide."""
    return predicates.all_of(
        [
            predicates.between(F.col("age"), params.start_age, params.end_age),
            predicates.one_of(F.col("professional"), params.professionals),
            predicates.one_of(F.col("city"), params.cities),
            predicates.equals(F.col("sex"), params.sex),
        ]
    )


def hit_filter(params: TaskParams) -> Column:
    """The part of the filter that the session's own actions decide."""
    return predicates.all_of(
        [
            None if params.keywords is None else F.col("keyword_hit"),
            None if params.category_ids is None else F.col("category_hit"),
        ]
    )


def select_sessions(actions: DataFrame, users: DataFrame, params: TaskParams, lists: bool = False) -> DataFrame:
    """Sessions with user attributes that pass every filter the task asks for."""
    sessions = rollup(actions, params, lists).where(hit_filter(params)).drop("keyword_hit", "category_hit")
    return with_users(sessions, users.where(user_filter(params)))


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions whose session is among `sessions`."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def _in_bucket(col: Column, borders: tuple[int, int | None]) -> Column:
    low, high = borders
    return col >= low if high is None else col.between(low, high)


def length_counts(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions, in all and per bucket."""
    counts = [F.count("*").alias("session_count")]
    for buckets, col in ((VISIT_BUCKETS, "visit_length"), (STEP_BUCKETS, "step_length")):
        counts += [F.count_if(_in_bucket(F.col(col), b)).alias(name) for name, b in buckets.items()]
    return sessions.agg(*counts)


def length_stats(sessions: DataFrame, task_id: int) -> DataFrame:
    """One row: session count and the share of every bucket, two decimals half up."""
    whole = F.col("session_count")
    return length_counts(sessions).select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        whole,
        *[numbers.ratio(F.col(c), whole).alias(f"{c}_ratio") for c in [*VISIT_BUCKETS, *STEP_BUCKETS]],
    )


def details(actions: DataFrame, task_id: int, source: str | Column) -> DataFrame:
    """Actions as rows of the session detail table. `source` tells which report asked."""
    return actions.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        "user_id",
        "session_id",
        "page_id",
        times.as_text(actions, "action_time").alias("action_time"),
        "search_keyword",
        "click_category_id",
        "click_product_id",
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
    )
