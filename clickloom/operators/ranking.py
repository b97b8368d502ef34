"""Ranked cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


# A result of at most this many rows is small enough to send to every task.
BROADCAST_ROWS = 100_000


def bounded(small: DataFrame, rows: int) -> DataFrame:
    """Ask for a broadcast if the proven row bound allows it, else let the planner choose."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def top_n(df: DataFrame, n: int, order: list[Column], keys: list[str] | None = None, rank: str = "rank") -> DataFrame:
    """First `n` rows by `order`, per `keys` if given. `order` must end in a tie-break.

    Per key, the literal bound on row_number lets every task cut its rows to `n`
    a key before the shuffle, so one huge key sends no more than n rows a task.
    """
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col(rank) <= n
    )
