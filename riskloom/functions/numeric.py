"""Scalar arithmetic with nulls in the place of NaN and infinities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def log(x: Column) -> Column:
    """Natural logarithm; null for what isn't positive."""
    return F.when(x > 0, F.ln(x))


def clip(x: Column, low: Column, high: Column) -> Column:
    """``x`` within bounds; null if any of the three is."""
    return F.when(x.isNotNull() & low.isNotNull() & high.isNotNull(), F.greatest(low, F.least(high, x)))


def total(terms: list[Column]) -> Column:
    """Sum that is null if any term is."""
    return reduce(lambda a, b: a + b, terms)


def rounded(x: Column, digits: int = 6) -> Column:
    """For comparison across engines: rounded, and without a negative zero."""
    return F.round(x, digits) + F.lit(0.0)
