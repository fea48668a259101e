"""The daily report as a table of lines."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import hourly_rate, money, percent, pounds, ratio, segment_rank
from tillroll.operators.percentile import exact_percentile
from tillroll.operators.star import on_previous_day, roll_up
from tillroll.schemas import Star
from tillroll.sources.shared import stage

# Sections in reading order.
SECTIONS = ("summary", "underperformers", "velocity", "segments", "insights")
# Trucks whose revenue lies under this percentile underperform.
POOR = 25


class NoSales(ValueError):
    """The reported day has no sales."""


def _display() -> Column:
    """What a line shows of its value and percentage."""
    section, value, pct = F.col("section"), F.col("value"), F.col("pct")
    return (
        F.when(section == "velocity", hourly_rate(value))
        .when(section == "segments", F.concat(money(value), F.lit(", "), percent(pct)))
        .when(section == "insights", F.concat(percent(pct), F.lit(" of revenue")))
        .when(pct.isNotNull(), F.concat(percent(pct), F.lit(" of transactions")))
        .otherwise(money(value))
    )


def day_sums(sales: DataFrame) -> DataFrame:
    """All sums of the report in one aggregation: by truck, by price segment and of everything.

    `kind` tells them apart. The mean revenue of a truck's hours is its revenue over the number
    of its hours, which a bit mask counts beside the sums, so hours need no grouping of their
    own. A truck without a name has no row, but counts in the other sums.
    """
    grouped = sales.groupingSets(
        [[F.col("truck_name")], [F.col("price_segment")], []], F.col("truck_name"), F.col("price_segment")
    ).agg(
        F.grouping_id().alias("level"),
        F.coalesce(F.sum("pence"), F.lit(0)).alias("pence"),
        F.sum("sales").alias("sales"),
        F.bit_count(F.bit_or(F.expr("shiftleft(1, hour_of_day)"))).alias("hours"),
    )
    kind = F.when(F.col("level") == 1, "truck").when(F.col("level") == 2, "segment").otherwise("all")
    named = grouped.withColumn("kind", kind).where("kind <> 'truck' OR truck_name IS NOT NULL")
    return named.select("kind", "truck_name", "price_segment", "pence", "sales", "hours")


def _first(kind: str, *order: Column) -> Column:
    """The first row of a kind by an order, as a struct."""
    keys = [c.alias(f"order_{i}") for i, c in enumerate(order)]
    return F.min(F.when(F.col("kind") == kind, F.struct(*keys, "truck_name", "price_segment", "pence", "sales")))


def _line(section: str, sort_key: Column, label: Column, value: Column, pct: Column | None = None) -> Column:
    return F.struct(
        F.lit(SECTIONS.index(section) + 1).alias("section_no"),
        F.lit(section).alias("section"),
        sort_key.cast("double").alias("sort_key"),
        label.alias("label"),
        value.cast("double").alias("value"),
        (F.lit(None) if pct is None else pct).cast("double").alias("pct"),
    )


def _lines(sums: DataFrame, lines: list[Column]) -> DataFrame:
    """Several lines of each row, those that apply to it."""
    made = sums.select(F.explode(F.array(*lines)).alias("line"))
    return made.where("line IS NOT NULL").select("line.*")


def report_lines(sums: DataFrame) -> DataFrame:
    """All lines of the report from its sums.

    Lines sort by `section_no`, `sort_key` and `label`. The key is a rank or a revenue
    rather than a running number, so a long list of trucks needs no single-task numbering.
    First and last places are one aggregation to a single row; the rest is a line or two for
    each sum.
    """
    kind, pence, rank = F.col("kind"), F.col("pence"), segment_rank(F.col("price_segment"))
    whole = sums.where(kind == "segment").agg(F.sum("pence")).scalar()
    share = lambda part, total: ratio(part, total) * 100
    picked = sums.agg(
        F.max(F.when(kind == "all", pence)).alias("pence"),
        F.sum(F.when(kind == "segment", F.col("sales"))).alias("sales"),
        _first("truck", -pence, F.col("truck_name")).alias("best"),
        _first("truck", pence, F.col("truck_name")).alias("worst"),
        _first("segment", -F.col("sales"), rank).alias("demanded"),
        _first("segment", -share(pence, whole), rank).alias("dominant"),
    )
    summary = _lines(
        picked,
        [
            _line("summary", F.lit(1), F.lit("total revenue"), pounds(pence)),
            F.when(
                F.col("demanded").isNotNull(),
                _line(
                    "summary", F.lit(2),
                    F.concat(F.lit("most demanded segment: "), F.col("demanded.price_segment")),
                    F.col("demanded.sales"), share(F.col("demanded.sales"), F.col("sales")),
                ),
            ),
            *(
                F.when(
                    F.col(place).isNotNull(),
                    _line(
                        "summary", F.lit(number),
                        F.concat(F.lit(f"{place} truck: "), F.col(f"{place}.truck_name")),
                        pounds(F.col(f"{place}.pence")),
                    ),
                )
                for number, place in ((3, "best"), (4, "worst"))
            ),
            F.when(
                F.col("dominant").isNotNull(),
                _line(
                    "insights", F.lit(1),
                    F.concat(F.lit("dominant segment: "), F.col("dominant.price_segment")),
                    pounds(F.col("dominant.pence")), share(F.col("dominant.pence"), whole),
                ),
            ),
        ],
    )
    threshold = exact_percentile(sums.where(kind == "truck"), "pence", POOR / 100).scalar()
    hourly = ratio(pence, F.col("hours"))
    each = _lines(
        sums,
        [
            F.when((kind == "truck") & (pence < threshold), _line("underperformers", pence, F.col("truck_name"), pounds(pence))),
            F.when((kind == "truck") & (F.col("hours") > 0), _line("velocity", -hourly, F.col("truck_name"), hourly / 100)),
            F.when(kind == "segment", _line("segments", rank, F.col("price_segment"), pounds(pence), share(pence, whole))),
        ],
    )
    return summary.union(each).withColumn("display", _display())


def daily_report(star: Star, as_of: date) -> DataFrame:
    """The report on the day before `as_of`, one line per row, in reading order.

    The fact is read once, for that day only, and summed once for all sections. The sums, a row
    for each truck and segment, are staged, and every line is worked out from them.
    """
    day = as_of - timedelta(days=1)
    rolled = roll_up(on_previous_day(star, as_of), "hour_of_day", "price_segment")
    sums = stage(day_sums(rolled))
    if sums.where("kind = 'segment'").isEmpty():
        raise NoSales(f"no transactions for {day}")
    dated = report_lines(sums).withColumn("report_date", F.lit(day))
    return dated.orderBy("section_no", "sort_key", "label")
