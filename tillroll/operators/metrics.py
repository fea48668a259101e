"""Business measures over the star.

Each takes `sales`, which is either rows of `star_join` or a `roll_up` that kept the grain
the measure needs. Groups with a missing key are left out, a sum over nothing is zero,
and money is added up in whole pence and turned into pounds at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import pounds, ratio, segment_rank
from tillroll.operators.filters import selected
from tillroll.operators.percentile import exact_percentile
from tillroll.operators.star import as_measures
from tillroll.sources.shared import stage


def _grouped(sales: DataFrame, *keys: str):
    measures = as_measures(sales)
    for key in keys:
        measures = measures.where(F.col(key).isNotNull())
    return measures.groupBy(*keys)


def _pence() -> Column:
    return F.coalesce(F.sum("pence"), F.lit(0))


def pence_by_truck(sales: DataFrame) -> DataFrame:
    """Revenue in pence and number of sales per truck; what the rankings start from."""
    return _grouped(sales, "truck_name").agg(
        _pence().alias("pence"), F.sum("sales").alias("sales")
    )


def revenue_by_truck(sales: DataFrame) -> DataFrame:
    return _grouped(sales, "truck_name").agg(pounds(_pence()).alias("total_pounds"))


def daily_revenue(sales: DataFrame) -> DataFrame:
    return _grouped(sales, "truck_name", "date").agg(pounds(_pence()).alias("total_pounds"))


def cumulative_revenue(sales: DataFrame, names=None) -> DataFrame:
    """Running revenue of each truck by date, dates without a sale left out.

    The window sees one row per truck and day, never a sale, so the longest partition is
    the number of days a truck traded.
    """
    daily = _grouped(selected(as_measures(sales), names), "truck_name", "date").agg(
        _pence().alias("pence")
    )
    so_far = (
        Window.partitionBy("truck_name")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.select(
        "truck_name",
        "date",
        pounds(F.sum("pence").over(so_far)).alias("cumulative_total_pounds"),
    ).orderBy("date", "truck_name")


def payment_distribution(sales: DataFrame, names=None) -> DataFrame:
    return _grouped(selected(as_measures(sales), names), "truck_name", "payment_method").agg(
        F.sum("sales").alias("count")
    )


def average_amount_by_hour(sales: DataFrame, names=None) -> DataFrame:
    """Mean sale per truck and hour of day, in that order."""
    return (
        _grouped(selected(as_measures(sales), names), "truck_name", "hour_of_day")
        .agg(
            pounds(ratio(F.sum("pence"), F.sum("priced"))).alias("average_transaction_amount")
        )
        .orderBy("truck_name", "hour_of_day")
    )


def hourly_pence(sales: DataFrame) -> DataFrame:
    """Mean revenue in pence over the hours of day in which a truck sold anything.

    The mean of hourly sums is the total over the number of distinct hours. There are 24
    possible hours, so a bit mask counts them inside the one aggregation by truck.
    """
    hours = F.bit_count(F.bit_or(F.expr("shiftleft(1, hour_of_day)")))
    measures = as_measures(sales).where(F.col("hour_of_day").isNotNull())
    return _grouped(measures, "truck_name").agg(ratio(_pence(), hours).alias("hourly_pence"))


def revenue_velocity(sales: DataFrame) -> DataFrame:
    """Average revenue per active hour, fastest truck first."""
    return (
        hourly_pence(sales)
        .select("truck_name", pounds(F.col("hourly_pence")).alias("avg_revenue_per_hour"))
        .orderBy(F.desc("avg_revenue_per_hour"), "truck_name")
    )


def _performance(by_truck: DataFrame) -> DataFrame:
    revenue = pounds(F.col("pence"))
    return by_truck.select(
        "truck_name",
        revenue.alias("total_pounds"),
        F.col("sales").alias("transaction_id"),
        ratio(revenue, F.col("sales")).alias("revenue_per_transaction"),
    )


def truck_performance(sales: DataFrame) -> DataFrame:
    """Revenue, number of sales (as `transaction_id`) and revenue per sale of each truck."""
    return _performance(pence_by_truck(sales))


def below_percentile(by_truck: DataFrame, threshold_percentile: float = 25) -> DataFrame:
    """Rows of `pence_by_truck` strictly under the percentile of revenue."""
    threshold = exact_percentile(by_truck, "pence", threshold_percentile / 100)
    return by_truck.where(F.col("pence") < threshold.scalar())


def underperforming_trucks(sales: DataFrame, threshold_percentile: float = 25) -> DataFrame:
    """Trucks whose revenue lies strictly under the percentile, poorest first.

    Revenue by truck is staged because the threshold and the comparison both read it.
    """
    by_truck = stage(pence_by_truck(sales))
    return _performance(below_percentile(by_truck, threshold_percentile)).orderBy(
        "total_pounds", "truck_name"
    )


def total_pence(sales: DataFrame) -> DataFrame:
    return as_measures(sales).agg(_pence().alias("pence"))


def total_revenue(sales: DataFrame) -> DataFrame:
    """Revenue over all sales, those of unnamed trucks included."""
    return total_pence(sales).select(pounds(F.col("pence")).alias("total_pounds"))


def revenue_for_truck(sales: DataFrame, name: str) -> DataFrame:
    """Revenue of one truck, zero when it sold nothing."""
    return total_revenue(as_measures(sales).where(F.col("truck_name") == name))


def average_truck_revenue(sales: DataFrame) -> DataFrame:
    """Mean of the trucks' revenues."""
    return pence_by_truck(sales).agg(
        pounds(ratio(F.sum("pence"), F.count(F.lit(1)))).alias("average_revenue")
    )


def distinct_trucks(sales: DataFrame) -> DataFrame:
    """Names that have sales, for a choice list."""
    return sales.select("truck_name").distinct().orderBy("truck_name")


def price_segmentation(sales: DataFrame) -> DataFrame:
    """Sales (as `transaction_id`) and revenue per price segment with their shares of the
    whole, cheapest segment first; segments without sales are absent."""
    segments = _grouped(sales, "price_segment").agg(
        F.sum("sales").alias("transaction_id"), _pence().alias("pence")
    )
    whole = Window.partitionBy()  # at most three rows by now
    count, pence = F.col("transaction_id"), F.col("pence")
    return (
        segments.select(
            "price_segment",
            "transaction_id",
            pounds(pence).alias("total_pounds"),
            (ratio(count, F.sum(count).over(whole)) * 100).alias("percentage_of_transactions"),
            (ratio(pence, F.sum(pence).over(whole)) * 100).alias("percentage_of_revenue"),
        )
        .orderBy(segment_rank(F.col("price_segment")))
    )
