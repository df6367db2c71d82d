"""Rates, rounding, time gaps and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` to two digits; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def mean(total: Column, n: Column, digits: int) -> Column:
    return F.round(F.try_divide(total, n), digits)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; NULL unless both are there."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def amount(value: Column) -> Column:
    """A price as a decimal, so that sums do not depend on the order of the rows.

    What is no finite number becomes NULL.
    """
    return value.try_cast("decimal(28,6)")


def total_amount(value: Column) -> Column:
    return F.sum(amount(value)).cast("double")

