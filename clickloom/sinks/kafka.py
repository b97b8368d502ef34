"""Kafka in and out. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def source_options(servers: str, topic: str, group: str | None = None, offsets: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets}
    if group:
        options["kafka.group.id"] = group
    return options


def lines(spark: SparkSession, **source: str) -> DataFrame:
    """A topic as a stream of text lines (`value`)."""
    raw = spark.readStream.format("kafka").options(**source_options(**source)).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def messages(df: DataFrame, topic: str | Column) -> DataFrame:
    """Lines as Kafka rows. A column as topic routes each line to its own, such as by log type."""
    return df.select("value", (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))


def replay(df: DataFrame, servers: str, topic: str) -> None:
    """Write the lines of a file or table to a topic."""
    messages(df, topic).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish(stream: DataFrame, servers: str, topic: str | Column, checkpoint: str) -> StreamingQuery:
    writer = messages(stream, topic).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("checkpointLocation", checkpoint).start()
