"""Cutting lineage: a table written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickloom.session import shared_dir


def folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is written yet."""
    return f"{shared_dir(spark)}/clickloom-llm/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """`df` written once and read again. A lost executor then costs a read, not the
    work that led here. The folder stays for the cluster's own clean-up."""
    path = folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
