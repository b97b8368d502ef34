"""Tables of the batch model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def actions_between(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Actions of an inclusive date range; a missing bound is open.

    `date` holds yyyy-MM-dd text, so text order is date order. On a table
    partitioned by `date` this prunes partitions, otherwise it is pushed to the scan.
    """
    if start is not None:
        actions = actions.where(F.col("date") >= start)
    if end is not None:
        actions = actions.where(F.col("date") <= end)
    return actions
