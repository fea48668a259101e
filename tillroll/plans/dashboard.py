"""Everything a dashboard shows, from two small roll-ups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import percentage_difference, pounds, ratio
from tillroll.operators.metrics import (
    average_amount_by_hour,
    cumulative_revenue,
    distinct_trucks,
    payment_distribution,
    pence_by_truck,
)
from tillroll.operators.star import by_name, named, roll_up, summed_again
from tillroll.schemas import Star
from tillroll.sources.lake import (
    Lake,
    manifest,
    read_dimension,
    read_summaries,
    refresh_summary,
)


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame cached while its readers run. How long is the caller's choice."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def kpi_metrics(sales: DataFrame) -> DataFrame:
    """Best and worst truck, the mean revenue, and how far both are from it in percent.

    One aggregation over revenue by truck: the least (revenue, name) pair is the worst
    truck and the least (-revenue, name) pair the best, both with the right tie-break.
    """
    pair = pence_by_truck(sales).agg(
        F.min(F.struct((-F.col("pence")).alias("order"), "truck_name", "pence")).alias("best"),
        F.min(F.struct("pence", "truck_name")).alias("worst"),
        pounds(ratio(F.sum("pence"), F.count(F.lit(1)))).alias("average_revenue"),
    )
    best, worst = pounds(F.col("best.pence")), pounds(F.col("worst.pence"))
    average = F.col("average_revenue")
    return pair.where(F.col("best").isNotNull()).select(
        F.col("best.truck_name").alias("best_truck"),
        best.alias("best_revenue"),
        percentage_difference(best, average).alias("best_vs_average"),
        F.col("worst.truck_name").alias("worst_truck"),
        worst.alias("worst_revenue"),
        percentage_difference(worst, average).alias("worst_vs_average"),
        average,
    )


@dataclass(frozen=True)
class Dashboard:
    kpis: DataFrame
    names: DataFrame
    cumulative: DataFrame
    payment_mix: DataFrame
    average_by_hour: DataFrame


def dashboard(
    by_date: DataFrame, by_hour: DataFrame, names: Sequence[str] | None = None
) -> Dashboard:
    """The frames behind each widget, from sales by date and method and sales by hour. A
    selection of names narrows the charts, not the key figures."""
    return Dashboard(
        kpis=kpi_metrics(by_date),
        names=distinct_trucks(by_date),
        cumulative=cumulative_revenue(by_date, names),
        payment_mix=payment_distribution(by_date, names),
        average_by_hour=average_amount_by_hour(by_hour, names),
    )


@contextmanager
def open_dashboard(star: Star, names: Sequence[str] | None = None) -> Iterator[Dashboard]:
    """A dashboard whose frames read two cached roll-ups by name, one with methods and dates
    and one with hours; no chart needs both, and neither grows with the sales."""
    by_hour = by_name(roll_up(star, "hour_of_day").drop("payment_method"))
    with shared(by_name(roll_up(star, "date"))) as dates, shared(by_hour) as hours:
        yield dashboard(dates, hours, names)


def kept_sales(spark: SparkSession, lake: Lake, *grains: str) -> DataFrame:
    """What `roll_up` gives over the lake, from its kept sums: no sale is read."""
    state = manifest(spark, lake)
    sums = summed_again(read_summaries(spark, lake, state), *grains)
    return named(
        sums, read_dimension(spark, lake, "payment", state), read_dimension(spark, lake, "truck", state)
    )


@contextmanager
def open_lake_dashboard(
    spark: SparkSession, lake: Lake, names: Sequence[str] | None = None
) -> Iterator[Dashboard]:
    """A dashboard over all sales of the lake that reads none of those summed before. Sums are
    brought up to date from the loads that came since; names are looked up now."""
    refresh_summary(spark, lake)
    by_hour = by_name(kept_sales(spark, lake, "hour_of_day").drop("payment_method"))
    with shared(by_name(kept_sales(spark, lake, "date"))) as dates, shared(by_hour) as hours:
        yield dashboard(dates, hours, names)


def dashboard_lines(view: Dashboard) -> DataFrame:
    """All frames of a dashboard as lines: widget, label, detail and value."""

    def lines(df: DataFrame, widget: str, label: str, detail: str, value: str) -> DataFrame:
        return df.selectExpr(
            f"'{widget}' AS widget",
            f"{label} AS label",
            f"CAST({detail} AS STRING) AS detail",
            f"CAST({value} AS DOUBLE) AS value",
        )

    return (
        lines(view.kpis, "best", "best_truck", "NULL", "best_revenue")
        .union(lines(view.kpis, "worst", "worst_truck", "NULL", "worst_revenue"))
        .union(lines(view.names, "names", "truck_name", "NULL", "NULL"))
        .union(lines(view.cumulative, "cumulative", "truck_name", "date", "cumulative_total_pounds"))
        .union(lines(view.payment_mix, "payments", "truck_name", "payment_method", "count"))
        .union(lines(view.average_by_hour, "hours", "truck_name", "hour_of_day", "average_transaction_amount"))
    )
