"""Declared schemas. Nothing in this package infers a type from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# `total` is whole pence. A source with fractional pence would declare
# DecimalType(12, 2) here; no operator assumes more than exact addition.
TRANSACTION = StructType(
    [
        StructField("transaction_id", LongType()),
        StructField("truck_id", LongType()),
        StructField("payment_method_id", LongType()),
        StructField("total", LongType()),
        StructField("at", TimestampNTZType()),
    ]
)

PARTITION_COLUMNS = ("year", "month", "day")

LAKE_TRANSACTION = StructType(
    TRANSACTION.fields + [StructField(name, IntegerType()) for name in PARTITION_COLUMNS]
)

TRUCK = StructType(
    [
        StructField("truck_id", LongType()),
        StructField("truck_name", StringType()),
        StructField("has_card_reader", LongType()),
        StructField("fsa_rating", LongType()),
    ]
)

PAYMENT = StructType(
    [
        StructField("payment_method_id", LongType()),
        StructField("payment_method", StringType()),
    ]
)

# One row for each thing that a state of the lake consists of, see `sources.manifest`.
MANIFEST = StructType(
    [
        StructField("kind", StringType()),
        StructField("name", StringType()),
        StructField("load", LongType()),
        StructField("day", DateType()),
        StructField("at", TimestampNTZType()),
    ]
)

# Sales summed by their ids and every grain a measure can ask for.
SUMMARY = StructType(
    [
        StructField("truck_id", LongType()),
        StructField("payment_method_id", LongType()),
        StructField("date", DateType()),
        StructField("hour_of_day", IntegerType()),
        StructField("price_segment", StringType()),
        StructField("pence", LongType()),
        StructField("sales", LongType()),
        StructField("priced", LongType()),
    ]
)

# Last instant of history, taken by the initial load (inclusive).
HISTORY_CUTOFF = "2025-10-25 23:58:00"

# Price segments from cheapest to dearest, with their inclusive
# upper bound in pence (the dearest has none).
SEGMENTS = (
    ("Low (£0-5)", 500),
    ("Medium (£5-10)", 1000),
    ("High (£10+)", None),
)


@dataclass(frozen=True)
class Star:
    """One fact table and its two dimensions."""

    fact: DataFrame
    payment: DataFrame
    truck: DataFrame
