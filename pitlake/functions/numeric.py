"""Numeric column helpers shared by the quality operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_difference(a: Column, b: Column, floor: float) -> Column:
    """Absolute difference over the midpoint of magnitudes, the midpoint held above `floor`."""
    midpoint = (F.abs(a) + F.abs(b)) / 2
    return F.abs(a - b) / F.greatest(midpoint, F.lit(floor))


def floor_at_zero(c: Column) -> Column:
    """max(c, 0) that keeps null (plain `greatest` would turn null into 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda x, y: x | y, conditions)


def square(c: Column) -> Column:
    return c * c
