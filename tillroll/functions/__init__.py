from tillroll.functions.arithmetic import percentage_difference, pounds, ratio
from tillroll.functions.derive import (
    as_timestamp,
    hour_of_day,
    ntz,
    price_segment,
    sale_date,
    segment_rank,
    with_partition_columns,
)
from tillroll.functions.text import day_text, hourly_rate, money, percent, timestamp_text

__all__ = [
    "as_timestamp",
    "day_text",
    "hour_of_day",
    "hourly_rate",
    "money",
    "ntz",
    "percent",
    "percentage_difference",
    "pounds",
    "price_segment",
    "ratio",
    "sale_date",
    "segment_rank",
    "timestamp_text",
    "with_partition_columns",
]
