"""Cleaning of the transaction fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Validity:
    """What a believable sale looks like. The defaults are fixed values: six trucks,
    two payment methods, a positive total."""

    first_truck: int = 1
    last_truck: int = 6
    payment_methods: tuple[int, ...] = (1, 2)


def drop_nulls(df: DataFrame) -> DataFrame:
    """Rows with a value (neither null nor NaN) in every column."""
    return df.na.drop("any")


def drop_repeats(df: DataFrame) -> DataFrame:
    """One row per group of identical rows. Copies collapse inside each map task before
    the shuffle, so a row repeated very often sends one copy per task."""
    return df.dropDuplicates()


def valid_rows(df: DataFrame, rule: Validity = Validity()) -> DataFrame:
    return df.where(
        (F.col("total") > 0)
        & F.col("truck_id").between(rule.first_truck, rule.last_truck)
        & F.col("payment_method_id").isin(*rule.payment_methods)
    )


def clean_transactions(df: DataFrame, rule: Validity = Validity()) -> DataFrame:
    """Complete, valid and distinct rows. The per-row tests run first: they cannot change
    which whole rows are equal, and they shrink the one shuffle."""
    return drop_repeats(valid_rows(drop_nulls(df), rule))
