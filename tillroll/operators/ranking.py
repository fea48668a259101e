"""First and last places. Ties go to the alphabetically first truck and to the cheapest
segment; `limit` over an order is a per-task top-k, not a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import pounds, segment_rank
from tillroll.operators.metrics import pence_by_truck, price_segmentation


def _first_truck(sales: DataFrame, order: Column) -> DataFrame:
    first = pence_by_truck(sales).orderBy(order, "truck_name").limit(1)
    return first.select("truck_name", pounds(F.col("pence")).alias("total_pounds"))


def best_truck(sales: DataFrame) -> DataFrame:
    return _first_truck(sales, F.desc("pence"))


def worst_truck(sales: DataFrame) -> DataFrame:
    return _first_truck(sales, F.asc("pence"))


def _top_segment(segments: DataFrame, measure: str) -> DataFrame:
    return segments.orderBy(
        F.desc(measure), segment_rank(F.col("price_segment"))
    ).limit(1)


def top_segment_by_count(sales: DataFrame) -> DataFrame:
    """The segment with most sales."""
    return most_sold(price_segmentation(sales))


def top_segment_by_revenue(sales: DataFrame) -> DataFrame:
    """The segment with the largest share of revenue."""
    return most_earning(price_segmentation(sales))


def most_sold(segments: DataFrame) -> DataFrame:
    return _top_segment(segments, "transaction_id")


def most_earning(segments: DataFrame) -> DataFrame:
    return _top_segment(segments, "percentage_of_revenue")
