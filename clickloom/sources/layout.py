"""A table of actions laid out for session reports: by date, and by session within a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import sessions
from clickloom.sources.tables import actions_between
from clickloom.sources.tasks import TaskParams


class ActionTable:
    """Actions as two tables of the catalogue, `name` and `name`_hot, in folders below `folder`.

    Both are partitioned by date, so a range reads its own dates. In `name` the rows of a
    session are in one bucket, so rollups and joins by session do not shuffle it. A bucket
    is read by one task; hence sessions with more rows than a mean bucket, of which there are fewer
    than `buckets`, are in `name`_hot without buckets, where rollups combine before their
    shuffle and joins are split. Rows without a session are there as well.

    `date` is text like 2024-01-31 or null; an empty text would come back as null.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int):
        self.spark, self.name, self.folder, self.buckets = spark, name, folder, buckets

    def save(self, actions: DataFrame) -> ActionTable:
        """Replaces both tables. The list of hot sessions is written once and broadcast: it is
        shorter than the number of buckets. A task writes a bucket, with one file for each date."""
        rows = actions.count()
        long = F.col("rows") > max(rows // self.buckets, 1)
        sizes = actions.where("session_id is not null").groupBy("session_id").agg(F.count("*").alias("rows"))
        sizes.where(long).write.mode("overwrite").parquet(f"{self.folder}/{self.name}_sizes")
        hot = self.spark.read.schema("session_id string").parquet(f"{self.folder}/{self.name}_sizes")
        told = actions.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "session_id", "left")
        told = told.select(*actions.columns, "_hot")
        apart = F.col("_hot").isNotNull() | F.col("session_id").isNull()
        common = told.where(~apart).drop("_hot").repartition(self.buckets, "session_id")
        self._write(common.write.bucketBy(self.buckets, "session_id").sortBy("session_id"), self.name)
        self._write(told.where(apart).drop("_hot").hint("rebalance", F.col("date")).write, f"{self.name}_hot")
        return self

    def _write(self, writer, name: str) -> None:
        writer.mode("overwrite").partitionBy("date").format("parquet").option(
            "path", f"{self.folder}/{name}"
        ).saveAsTable(name)

    def parts(self, start: str | None = None, end: str | None = None) -> list[DataFrame]:
        """The bucketed actions of a range of dates, and the others. A session is in one of them."""
        tables = (self.spark.table(name) for name in (self.name, f"{self.name}_hot"))
        return [actions_between(t, start, end) for t in tables]

    def actions(self, params: TaskParams = TaskParams()) -> DataFrame:
        common, hot = self.parts(params.start_date, params.end_date)
        return common.unionByName(hot)

    def rollup(self, params: TaskParams = TaskParams(), lists: bool = False) -> DataFrame:
        """`sessions.rollup` of a range of dates."""
        common, hot = (sessions.rollup(p, params, lists) for p in self.parts(params.start_date, params.end_date))
        return common.unionByName(hot)

    def select_sessions(self, users: DataFrame, params: TaskParams, lists: bool = False) -> DataFrame:
        """`sessions.select_sessions` of a range of dates."""
        chosen = self.rollup(params, lists).where(sessions.hit_filter(params)).drop("keyword_hit", "category_hit")
        return sessions.with_users(chosen, users.where(sessions.user_filter(params)))

    def actions_of(self, chosen: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
        """The actions of these sessions in a range of dates."""
        common, hot = (sessions.actions_of(p, chosen) for p in self.parts(params.start_date, params.end_date))
        return common.unionByName(hot)

    def drop(self) -> None:
        """Takes both tables out of the catalogue; their files stay."""
        for name in (self.name, f"{self.name}_hot"):
            self.spark.sql(f"drop table if exists {name}")
