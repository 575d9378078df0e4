"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_nonneg(c: Column) -> Column:
    """Negative to 0, null and non-numeric to null."""
    n = c.try_cast("double")
    return F.when(n.isNotNull(), F.greatest(n, F.lit(0.0)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def cap_one(c: Column) -> Column:
    """Upper limit 1, null stays null."""
    return F.when(c > 1.0, 1.0).otherwise(c)


def unit(c: Column) -> Column:
    """Limit to [0, 1]."""
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def money(c: Column) -> Column:
    """Half-even rounding to cents."""
    return F.bround(c, 2)


def sum_or_zero(c: Column) -> Column:
    """Sum in which an all-null group gives 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def same_amount(diff: Column) -> Column:
    return F.abs(diff) < 0.01
