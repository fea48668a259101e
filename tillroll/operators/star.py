"""The star join, row by row and rolled up."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillroll.functions import hour_of_day, pounds, price_segment, sale_date
from tillroll.operators.filters import previous_day
from tillroll.schemas import Star

# A dimension is broadcast only when its rows measure less than this.
BROADCAST_BYTES = 64 * 1024 * 1024

# What a sale can be grouped by besides its two dimensions.
GRAINS = {
    "date": lambda: sale_date(F.col("at")),
    "hour_of_day": lambda: hour_of_day(F.col("at")),
    "price_segment": lambda: price_segment(F.col("total")),
}


def dimension_bytes(*dimensions: DataFrame) -> list[int]:
    """Measured size of each dimension, in one job: the text it holds plus 8 bytes per
    other field."""
    measured = []
    for number, dimension in enumerate(dimensions):
        texts = [f.name for f in dimension.schema.fields if isinstance(f.dataType, StringType)]
        fixed = 8 * (len(dimension.columns) - len(texts))
        row = " + ".join([f"{fixed}L", *[f"coalesce(octet_length(`{t}`), 0)" for t in texts]])
        measured.append(
            dimension.agg(
                F.lit(number).alias("number"),
                F.expr(f"coalesce(sum({row}), 0L)").alias("bytes"),
            )
        )
    sizes = reduce(DataFrame.unionByName, measured).collect()
    return [row["bytes"] for row in sorted(sizes, key=lambda row: row["number"])]


def _small_broadcast(broadcast_bytes: int, *dimensions: DataFrame) -> list[DataFrame]:
    """The dimensions, with a hint on those that measure no more than the bound."""
    sizes = dimension_bytes(*dimensions)
    return [F.broadcast(d) if size <= broadcast_bytes else d for d, size in zip(dimensions, sizes)]


def star_join(star: Star, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every sale with the names its ids stand for; sales without a match vanish.

    A dimension measured small is broadcast, so the fact stays where it is. Beyond the
    bound both sides shuffle on the key, and adaptive execution splits the tasks of a key
    that holds a large share of the fact.
    """
    payment = star.payment.select("payment_method_id", "payment_method")
    truck = star.truck.select("truck_id", "truck_name", "has_card_reader", "fsa_rating")
    payment, truck = _small_broadcast(broadcast_bytes, payment, truck)
    return (
        star.fact.join(payment, "payment_method_id")
        .join(truck, "truck_id")
        .select(
            "transaction_id",
            "truck_name",
            "payment_method",
            pounds(F.col("total")).alias("total_pounds"),
            "at",
            "has_card_reader",
            "fsa_rating",
            "total",
        )
    )


def on_previous_day(star: Star, as_of: date) -> Star:
    """The same star with its fact cut to the day before `as_of`, ahead of any join."""
    return replace(star, fact=previous_day(star.fact, as_of))


def _measures() -> list[Column]:
    return [
        F.sum("total").alias("pence"),
        F.count("transaction_id").alias("sales"),
        F.count("total").alias("priced"),
    ]


_IDS = ("truck_id", "payment_method_id")
_ADDED = ("pence", "sales", "priced")


def summed(fact: DataFrame, *grains: str) -> DataFrame:
    """Additive measures per truck id, payment method id and the given grains."""
    sales = fact.select(*_IDS, "transaction_id", "total", *[GRAINS[g]().alias(g) for g in grains])
    return sales.groupBy(*_IDS, *grains).agg(*_measures())


def summed_again(sums: DataFrame, *grains: str) -> DataFrame:
    """Sums of the same, or coarser, grains from sums."""
    return sums.groupBy(*_IDS, *grains).agg(*(F.sum(c).alias(c) for c in _ADDED))


def named(
    sums: DataFrame, payment: DataFrame, truck: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sums with the names their ids stand for.

    There are few payment methods, and sums by truck and day are as many as the sales they came
    from, so a shuffle on the method would sort all sums in as many tasks as there are methods.
    Payment methods measured small are broadcast, and the sums stay where they are.
    """
    payment = payment.select("payment_method_id", "payment_method")
    [payment] = _small_broadcast(broadcast_bytes, payment)
    return (
        sums.join(payment, "payment_method_id")
        .join(truck.select("truck_id", "truck_name"), "truck_id")
        .drop(*_IDS)
    )


def roll_up(star: Star, *grains: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Additive measures per truck, payment method and the given grains.

    The fact is summed by its ids before any join: each map task reduces a busy truck to
    a handful of rows, so no key is hot in the shuffle, names are hashed per group and
    not per sale, and the joins meet a small frame whatever size the dimensions have.
    Sums and counts are additive, so a dimension with repeated keys fans out the sums
    exactly as it would fan out the sales.
    """
    return named(summed(star.fact, *grains), star.payment, star.truck, broadcast_bytes)


def by_name(sales: DataFrame) -> DataFrame:
    """A roll-up summed once more, by names instead of ids. What is kept for several readers
    is then bounded by names, methods and grains, however many ids share a name."""
    keys = [c for c in sales.columns if c not in _ADDED]
    return sales.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _ADDED))


def as_measures(sales: DataFrame) -> DataFrame:
    """Bring rows of `star_join` into the shape of `roll_up`; a roll-up passes through.
    Grains a metric does not use are pruned from the plan."""
    if "pence" in sales.columns:
        return sales
    return sales.select(
        "truck_name",
        "payment_method",
        *[expression().alias(grain) for grain, expression in GRAINS.items()],
        F.col("total").alias("pence"),
        F.col("transaction_id").isNotNull().cast("long").alias("sales"),
        F.col("total").isNotNull().cast("long").alias("priced"),
    )
