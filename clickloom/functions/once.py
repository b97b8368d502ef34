"""Evaluating an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def once(col: Column) -> Column:
    """The same value, out of a one-element explode.

    The optimizer copies an expression into every filter and column that uses it,
    which is right for cheap ones. It does not do so across an explode, so a line
    is split, or a document parsed, a single time.
    """
    return F.explode(F.array(col))
