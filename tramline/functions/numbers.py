"""Numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def to_number(text: Column) -> Column:
    """Number in ``text``, or null where there is none.

    The pattern keeps out forms only Java reads as numbers, such as ``1d`` or ``0x1p3``;
    a number too large for a double is null, not infinite.
    """
    text = text.cast("string")
    value = text.try_cast("double")
    fits = (F.abs(value) < F.lit(float("inf"))) | text.rlike("(?i)inf")
    return F.when(text.rlike(NUMBER) & fits, value)


def ratio(part: Column, total: Column) -> Column:
    """``part / total``; null when the total is zero."""
    return F.try_divide(part, total)


def truncated(value: Column) -> Column:
    """Whole part, cut towards zero."""
    return value.cast("int")


def ordered_pair(low: Column, high: Column) -> tuple[Column, Column]:
    """The pair swapped where the first exceeds the second; null keeps the order."""
    swapped = low > high
    return F.when(swapped, high).otherwise(low), F.when(swapped, low).otherwise(high)
