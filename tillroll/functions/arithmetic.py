"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pounds(pence: Column) -> Column:
    """Pence to pounds, always fractional. Sum pence first and convert last:
    integer sums do not depend on the order partitions arrive in."""
    return pence / F.lit(100)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is null, not an ANSI error, when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def percentage_difference(value: Column, base: Column) -> Column:
    """How far `value` lies from `base` in percent of `base`; 0.0 for a zero base."""
    return F.when(base == 0, F.lit(0.0)).otherwise((value - base) / base * 100)
