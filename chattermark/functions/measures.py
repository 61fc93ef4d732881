"""Aggregate and ratio expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_with_null(column: str) -> Column:
    """Number of distinct values, where a missing value counts as one."""
    return F.countDistinct(column) + F.coalesce(
        F.max(F.col(column).isNull().cast("int")), F.lit(0)
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is 0 or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def guarded_ratio(numerator: Column, denominator: Column, otherwise=None) -> Column:
    """Quotient to four places, or `otherwise` unless the denominator is positive."""
    return F.when(denominator > 0, F.round(ratio(numerator, denominator), 4)).otherwise(
        F.lit(otherwise).cast("double")
    )
