"""Optional predicates: a filter that is not asked for is simply not there."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def between(col: Column, low: int | None, high: int | None) -> Column | None:
    """Inclusive range; needs both bounds. Null data fails."""
    if low is None or high is None:
        return None
    return col.between(low, high)


def one_of(col: Column, values: Iterable | None) -> Column | None:
    return None if values is None else col.isin(list(values))


def equals(col: Column, value: str | None) -> Column | None:
    return None if value is None else col == value


def any_match(col: Column, values: Iterable[str] | None) -> Column | None:
    """Does the comma list in `col` share a token with `values`? Null data fails."""
    if values is None:
        return None
    wanted = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.arrays_overlap(F.split(col, ","), wanted), F.lit(False))


def all_of(predicates: Iterable[Column | None]) -> Column:
    """And of those that are present; true when none is."""
    return reduce(and_, [p for p in predicates if p is not None], F.lit(True))
