"""The session analysis job: one task, five result tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from clickloom.operators import categories, sampling, sessions
from clickloom.operators.ranking import bounded
from clickloom.session import shared_dir
from clickloom.sinks.tables import Sink, TaskFiles
from clickloom.sources.tables import actions_between
from clickloom.sources.tasks import TaskParams, load_params


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from there.

    It is computed once however many reports read it, its lineage ends there, and a
    lost executor costs a read and not another pass over the actions.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def session_report(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    task_id: int,
    folder: str,
    sample_total: int = 100,
    seed: int = 42,
    top: int = 10,
) -> dict[str, DataFrame]:
    """The result tables by name.

    The raw actions are read three times: for the sessions, for the counts per
    session and category, and for the details of sampled and top sessions, which the
    few ids of both pick out in one pass. A session that is both has its actions in
    the details under either source.
    """
    chosen_actions = actions_between(actions, params.start_date, params.end_date)
    chosen = staged(
        sessions.select_sessions(chosen_actions, users, params).select(
            "session_id", "start_time", "visit_length", "step_length"
        ),
        folder,
        "sessions",
    )
    pairs = staged(
        sessions.actions_of(categories.session_category_counts(chosen_actions), chosen), folder, "session_categories"
    )
    ranked_categories = categories.top_categories(categories.category_counts(pairs), top)
    ranked_sessions = staged(
        categories.top_sessions(categories.category_session_clicks(pairs), ranked_categories, top, categories=top),
        folder,
        "top_sessions",
    )
    sample = sampling.sample_sessions(chosen, sample_total, seed)
    shown = sample.select("session_id", F.lit("sample").alias("source")).unionByName(
        ranked_sessions.select("session_id", F.lit("top").alias("source")).distinct()
    )
    shown_actions = staged(
        chosen_actions.join(bounded(shown, sample_total + top * top), "session_id"), folder, "shown_actions"
    )
    task = F.lit(task_id).cast("bigint").alias("task_id")
    return {
        "session_aggr_stat": sessions.length_stats(chosen, task_id),
        "session_random_extract": sampling.sample_report(shown_actions.where("source = 'sample'"), task_id),
        "session_detail": sessions.details(shown_actions, task_id, F.col("source")),
        "top10_category": ranked_categories.select(task, "*"),
        "top10_session": ranked_sessions.select(task, "*"),
    }


def run(tasks: DataFrame, task_id: int, actions: DataFrame, users: DataFrame, sink: Sink, **options) -> bool:
    """Look the task up, compute its reports, hand them to the sink, and commit them if the sink
    has commits. False if there is no such task."""
    params = load_params(tasks, task_id)
    if params is None:
        return False
    folder = f"{shared_dir(actions.sparkSession)}/clickloom/task-{task_id}-{uuid4().hex}"
    for table, df in session_report(actions, users, params, task_id, folder, **options).items():
        sink(table, task_id, df)
    if isinstance(sink, TaskFiles):
        sink.commit(actions.sparkSession, task_id)
    return True
