"""Result tables, as files or over JDBC. Every row carries its task id."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

# The result tables with their columns, in the order of the database.
RESULT_COLUMNS = {
    "session_aggr_stat": [
        "task_id",
        "session_count",
        "visit_length_1s_3s_ratio",
        "visit_length_4s_6s_ratio",
        "visit_length_7s_9s_ratio",
        "visit_length_10s_30s_ratio",
        "visit_length_30s_60s_ratio",
        "visit_length_1m_3m_ratio",
        "visit_length_3m_10m_ratio",
        "visit_length_10m_30m_ratio",
        "visit_length_30m_ratio",
        "step_length_1_3_ratio",
        "step_length_4_6_ratio",
        "step_length_7_9_ratio",
        "step_length_10_30_ratio",
        "step_length_30_60_ratio",
        "step_length_60_ratio",
    ],
    "session_random_extract": ["task_id", "session_id", "start_time", "search_keywords", "click_category_ids"],
    "session_detail": [
        "task_id",
        "user_id",
        "session_id",
        "page_id",
        "action_time",
        "search_keyword",
        "click_category_id",
        "click_product_id",
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
        "source",
    ],
    "top10_category": ["task_id", "category_id", "click_count", "order_count", "pay_count"],
    "top10_session": ["task_id", "category_id", "session_id", "click_count"],
}

# Takes the table, the task and the rows; the rows carry the task id too.
Sink = Callable[[str, int, DataFrame], None]


def files(folder: str) -> Sink:
    """Parquet in `folder`/table/task_id=N. A rerun of a task replaces its own rows, with
    none if there are none now, and nobody else's; a lost executor leaves no doubles."""

    def write(table: str, task_id: int, df: DataFrame) -> None:
        rows = df.select(*RESULT_COLUMNS[table]).drop("task_id")
        rows.write.mode("overwrite").parquet(f"{folder}/{table}/task_id={task_id}")

    return write


class TaskFiles:
    """A sink of files that replaces all tables of a task at once.

    Every run of a task writes its tables to new folders,
    `folder`/table/task_id=N/run=ID. `commit` adds one row to a table of commits, as one file
    that appears whole; from then on `read` gives the rows of that run, and until then
    those of the run before, whatever has been written of the new one. A run that dies
    leaves folders that no commit names. One task has one run at a time.
    """

    COMMITS = "task_id bigint, run string, nth bigint"

    def __init__(self, folder: str):
        self.folder, self.runs = folder, {}

    def __call__(self, table: str, task_id: int, df: DataFrame) -> None:
        run = self.runs.setdefault(task_id, uuid4().hex)
        rows = df.select(*RESULT_COLUMNS[table]).drop("task_id")
        rows.write.parquet(f"{self.folder}/{table}/task_id={task_id}/run={run}")

    def commit(self, spark: SparkSession, task_id: int) -> None:
        """Make the tables written for the task since its last commit the ones to read. A
        table that was not written has no rows for the task."""
        before = self._commits(spark).agg(F.max("nth")).first()[0] or 0
        row = spark.createDataFrame([(task_id, self.runs.pop(task_id, uuid4().hex), before + 1)], self.COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")

    def _commits(self, spark: SparkSession) -> DataFrame:
        """None in a new folder."""
        spark.createDataFrame([], self.COMMITS).write.mode("ignore").parquet(f"{self.folder}/commits")
        return spark.read.schema(self.COMMITS).parquet(f"{self.folder}/commits")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of every task's last committed run. Partition pruning leaves other runs
        unread."""
        last = self._commits(spark).groupBy("task_id").agg(F.max_by("run", "nth").alias("run"))
        rows = spark.read.option("basePath", f"{self.folder}/{table}").parquet(f"{self.folder}/{table}")
        named = rows.withColumns({"task_id": F.col("task_id").cast("bigint"), "run": F.col("run").cast("string")})
        return named.join(last, ["task_id", "run"], "left_semi").select(*RESULT_COLUMNS[table])


def jdbc(url: str, batch_size: int = 10_000, connections: int = 16, **options: str) -> Sink:
    """Append over JDBC, in batches, from at most `connections` tasks at a time.

    Each partition is one transaction, so a task that fails leaves nothing behind.
    A whole job that is run again appends again: delete its task id first.
    """

    def write(table: str, task_id: int, df: DataFrame) -> None:
        writer = df.select(*RESULT_COLUMNS[table]).write.format("jdbc").mode("append")
        settings = {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}
        writer.options(**settings, **options).save()

    return write
