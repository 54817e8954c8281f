"""Aggregate expressions with an exact and a sketch form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_count(column: str, approx: bool = False) -> Column:
    """Number of distinct non-NULL values; ``approx`` trades it for a sketch.

    The exact form shuffles on (group, value) first, which also spreads a hot
    group, and then merges one partial count per task and group.
    """
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


# Twelve digits after the point hold what measures are written with, and sums of them are exact.
MEASURE = "decimal(26, 12)"


def number(column: str) -> Column:
    """A measure held as double or as text, as a decimal; NULL for text that is no number."""
    return F.col(column).try_cast(MEASURE)


def exact_mean(total: Column, n: Column) -> Column:
    """Mean from an exact sum, to 23 digits."""
    return F.try_divide(total.try_cast(MEASURE), n.cast("decimal(10, 0)"))


def whole_part(mean: Column) -> Column:
    """A mean cut off after the decimal point.

    Sums are exact and so do not depend on the order of rows; only the last of the 23 digits of an hourly
    mean is rounded, which 15 digits settle for means that are whole numbers.
    """
    return F.round(mean.cast("decimal(38, 20)"), 15).cast("bigint")
