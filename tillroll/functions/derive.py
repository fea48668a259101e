"""Columns derived from the sale timestamp and the price."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import SEGMENTS


def ntz(value: str | datetime) -> Column:
    """Timestamp literal without zone. A plain `lit(datetime)` is zoned, which would
    put a cast on the compared column and keep the filter out of the scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def as_timestamp(text: Column) -> Column:
    return text.cast("timestamp_ntz")


def sale_date(at: Column) -> Column:
    return F.to_date(at)


def hour_of_day(at: Column) -> Column:
    return F.hour(at)


def with_partition_columns(df: DataFrame, at: str = "at") -> DataFrame:
    """Add the year, month and day the lake is partitioned by."""
    return df.withColumns(
        {
            "year": F.year(at),
            "month": F.month(at),
            "day": F.dayofmonth(at),
        }
    )


def price_segment(pence: Column) -> Column:
    """Segment label of a price; a missing price counts as the dearest segment."""
    (low, low_top), (medium, medium_top), (high, _) = SEGMENTS
    return (
        F.when(pence <= low_top, F.lit(low))
        .when(pence <= medium_top, F.lit(medium))
        .otherwise(F.lit(high))
    )


def segment_rank(segment: Column) -> Column:
    """Position of a segment label, cheapest first."""
    return F.array_position(F.array(*[F.lit(label) for label, _ in SEGMENTS]), segment)
