"""Row selection by calendar day and by truck name."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import ntz
from tillroll.schemas import PARTITION_COLUMNS


def _has_partitions(df: DataFrame) -> bool:
    return set(PARTITION_COLUMNS) <= set(df.columns)


def between_days(df: DataFrame, first: date, last: date) -> DataFrame:
    """Sales from `first` to `last`, both included.

    Bounds on `at` reach the Parquet row-group filter. On the lake they do not prune
    folders, so the same range is also put on the partition columns.
    """
    rows = df.where(
        (F.col("at") >= ntz(f"{first} 00:00:00"))
        & (F.col("at") < ntz(f"{last + timedelta(days=1)} 00:00:00"))
    )
    if not _has_partitions(df):
        return rows
    if first == last:
        return rows.where(
            (F.col("year") == first.year)
            & (F.col("month") == first.month)
            & (F.col("day") == first.day)
        )
    # the bare year is what a metastore can filter by itself
    return rows.where(F.col("year").between(first.year, last.year)).where(
        F.make_date("year", "month", "day").between(F.lit(first), F.lit(last))
    )


def on_day(df: DataFrame, day: date) -> DataFrame:
    return between_days(df, day, day)


def previous_day(df: DataFrame, as_of: date) -> DataFrame:
    """Sales of the day before `as_of`."""
    return on_day(df, as_of - timedelta(days=1))


def selected(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Rows of the named trucks: all of them for `None`, none for an empty list."""
    if names is None:
        return df
    return df.where(F.col("truck_name").isin(list(names)))
