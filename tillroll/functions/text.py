"""Display text. `format_number` rounds half-even on the exact binary value, which is
what fixed-point formatting does outside the JVM too; `printf`-style formatting in the
JVM rounds the shortest decimal half-up and would differ on ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fixed(value: Column, places: int) -> Column:
    pattern = "0." + "0" * places
    return F.call_function("format_number", value, F.lit(pattern))


def money(value: Column) -> Column:
    """£1,234.50"""
    return F.concat(F.lit("£"), F.format_number(value, 2))


def percent(value: Column, places: int = 1) -> Column:
    """12.3%"""
    return F.concat(_fixed(value, places), F.lit("%"))


def hourly_rate(value: Column) -> Column:
    """£1234.50/hour"""
    return F.concat(F.lit("£"), _fixed(value, 2), F.lit("/hour"))


def timestamp_text(at: Column) -> Column:
    """Whole seconds, as yyyy-MM-dd HH:mm:ss. `date_format` would go through the session
    time zone and move a time that does not exist there."""
    return F.left(at.cast("timestamp_ntz").cast("string"), F.lit(19))


def day_text(day: Column) -> Column:
    """yyyy-MM-dd"""
    return day.cast("string")
