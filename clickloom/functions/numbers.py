"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole rounded half up, through integers so that no engine's double
    rounding shows; null when `whole` is zero."""
    unit = 10**scale
    twice = 2 * unit * part + whole
    steps = (twice - F.pmod(twice, 2 * whole)) / (2 * whole)
    return F.when(whole != 0, steps / F.lit(float(unit)))


def format_double(col: Column, scale: int) -> Column:
    """Half-up rounding of the double's exact binary value, so 0.285 gives 0.28.

    The value is compared with the tie above its floor. Splitting it into two
    26-bit halves makes both products, and so the comparison, exact.
    """
    unit = 10**scale
    size = F.abs(col)
    whole = F.floor(size * unit)
    wide = size * F.lit(134217729.0)
    high = wide - (wide - size)
    low = size - high
    past_tie = (high * (2 * unit) - (2 * whole + 1)) + low * (2 * unit) >= 0
    return F.sign(col) * (whole + past_tie.cast("int")) / F.lit(float(unit))
