"""The places where a measure is easy to get subtly wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from tillroll.functions import (
    day_text,
    hour_of_day,
    hourly_rate,
    money,
    percent,
    percentage_difference,
    price_segment,
    ratio,
    sale_date,
    segment_rank,
    timestamp_text,
)
from tillroll.operators import metrics, ranking
from tillroll.operators.clean import Validity, clean_transactions, drop_nulls
from tillroll.operators.filters import previous_day, selected
from tillroll.operators.star import as_measures, by_name, roll_up, star_join
from tillroll.plans.dashboard import dashboard, kpi_metrics, open_dashboard
from tillroll.plans.report import NoSales, daily_report
from tillroll.schemas import SEGMENTS, TRANSACTION, Star
from tillroll.sources import (
    new_folder,
    read_csv,
    read_mark,
    read_transactions,
    write_csv,
    write_mark,
    write_transactions,
)

LOW, MEDIUM, HIGH = (label for label, _ in SEGMENTS)
NOON = "2024-01-15 12:00:00"


def both(star, operator, *grains):
    """The measure over joined rows, asserted equal to the one over the roll-up."""
    from_rows = rows(operator(star_join(star)))
    from_sums = rows(operator(roll_up(star, *grains)))
    assert sorted(from_rows, key=repr) == sorted(from_sums, key=repr)
    return from_rows


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_pounds_are_fractional(fleet):
    joined = star_join(fleet((1, 1, 1, 655, NOON))).first()
    assert joined["total_pounds"] == 6.55
    assert joined["total"] == 655


def test_sums_are_exact_in_pence(fleet):
    star = fleet(*[(i, 1, 1, 10, NOON) for i in range(30)])
    assert both(star, metrics.total_revenue) == [(3.0,)]


def test_unnamed_trucks_are_in_the_total_but_in_no_group(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 4, 1, 900, NOON))
    assert both(star, metrics.revenue_by_truck) == [("A", 1.0)]
    assert both(star, metrics.total_revenue) == [(10.0,)]


def test_sum_of_only_nulls_is_zero_and_mean_is_null(fleet):
    star = fleet((1, 1, 1, None, NOON), (2, 1, 1, None, NOON))
    assert both(star, metrics.revenue_by_truck) == [("A", 0.0)]
    assert both(star, metrics.average_amount_by_hour, "hour_of_day") == [("A", 12, None)]


def test_null_ids_are_not_counted(fleet):
    star = fleet((None, 1, 1, 100, NOON), (2, 1, 1, 100, NOON))
    assert both(star, metrics.payment_distribution) == [("A", "cash", 1)]
    assert both(star, metrics.truck_performance) == [("A", 2.0, 1, 2.0)]


def test_null_prices_do_not_lower_the_mean(fleet):
    star = fleet((1, 1, 1, 300, NOON), (2, 1, 1, None, NOON))
    assert both(star, metrics.average_amount_by_hour, "hour_of_day") == [("A", 12, 3.0)]


def test_ties_go_to_the_first_name(fleet):
    star = fleet((1, 3, 1, 500, NOON), (2, 2, 1, 500, NOON), (3, 1, 1, 500, NOON))
    assert both(star, ranking.best_truck) == [("A", 5.0)]
    assert both(star, ranking.worst_truck) == [("A", 5.0)]
    kpis = kpi_metrics(star_join(star)).first()
    assert (kpis["best_truck"], kpis["worst_truck"]) == ("A", "A")


def test_tied_segments_go_to_the_cheaper(fleet):
    star = fleet((1, 1, 1, 1100, NOON), (2, 1, 1, 400, NOON), (3, 1, 1, 700, NOON), (4, 1, 1, 400, NOON))
    assert both(star, ranking.top_segment_by_count, "price_segment")[0][0] == LOW
    tied = fleet((1, 1, 1, 600, NOON), (2, 1, 1, 300, NOON), (3, 1, 1, 300, NOON))
    assert both(tied, ranking.top_segment_by_revenue, "price_segment")[0][0] == LOW


def test_nothing_in_nothing_out(fleet):
    star = fleet()
    for operator in (
        metrics.revenue_by_truck,
        metrics.cumulative_revenue,
        metrics.underperforming_trucks,
        metrics.revenue_velocity,
        metrics.price_segmentation,
        ranking.best_truck,
        ranking.worst_truck,
        ranking.top_segment_by_count,
        kpi_metrics,
    ):
        assert rows(operator(star_join(star))) == []
    assert rows(metrics.total_revenue(star_join(star))) == [(0.0,)]
    assert rows(metrics.average_truck_revenue(star_join(star))) == [(None,)]


def test_report_refuses_an_empty_day(fleet):
    with pytest.raises(NoSales, match="no transactions for 2024-01-19"):
        daily_report(fleet((1, 1, 1, 100, NOON)), date(2024, 1, 20))


def test_underperformers_lie_strictly_under_the_exact_percentile(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 1, 200, NOON), (3, 3, 1, 300, NOON))
    # 25th percentile of 1, 2, 3 is 1.5; the median is 2 and not under itself
    assert [r[0] for r in both(star, metrics.underperforming_trucks)] == ["A"]
    half = lambda sales: metrics.underperforming_trucks(sales, 50)
    assert [r[0] for r in both(star, half)] == ["A"]


def test_one_truck_does_not_underperform(fleet):
    assert both(fleet((1, 1, 1, 100, NOON)), metrics.underperforming_trucks) == []


@pytest.mark.parametrize(
    ("pence", "label"),
    [(-300, LOW), (500, LOW), (501, MEDIUM), (1000, MEDIUM), (1001, HIGH), (None, HIGH)],
)
def test_segment_edges(spark, pence, label):
    assert value(spark, price_segment(F.lit(pence).cast("long"))) == label


def test_segment_order(spark):
    ranks = [value(spark, segment_rank(F.lit(label))) for label in (LOW, MEDIUM, HIGH)]
    assert ranks == [1, 2, 3]


def test_absent_segments_have_no_row_and_shares_fill_the_whole(fleet):
    star = fleet((1, 1, 1, 1500, NOON), (2, 1, 1, 250, NOON), (3, 2, 2, 250, NOON))
    found = both(star, metrics.price_segmentation, "price_segment")
    assert found == [
        (LOW, 2, 5.0, pytest.approx(200 / 3), 25.0),
        (HIGH, 1, 15.0, pytest.approx(100 / 3), 75.0),
    ]


def test_shares_of_nothing_are_null(fleet):
    assert both(fleet((1, 1, 1, 0, NOON)), metrics.price_segmentation, "price_segment") == [
        (LOW, 1, 0.0, 100.0, None)
    ]


def test_zero_denominators(spark):
    assert value(spark, ratio(F.lit(5.0), F.lit(0))) is None
    assert value(spark, percentage_difference(F.lit(5.0), F.lit(0.0))) == 0.0
    assert value(spark, percentage_difference(F.lit(15.0), F.lit(10.0))) == 50.0


def test_velocity_merges_an_hour_over_days_and_skips_idle_hours(fleet):
    star = fleet(
        (1, 1, 1, 100, "2024-01-15 09:10:00"),
        (2, 1, 1, 300, "2024-01-16 09:50:00"),
        (3, 1, 1, 200, "2024-01-16 17:00:00"),
        (4, 2, 1, 900, "2024-01-16 23:59:59"),
    )
    assert both(star, metrics.revenue_velocity, "hour_of_day") == [("B", 9.0), ("A", 3.0)]


def test_cumulative_skips_days_without_sales(fleet):
    star = fleet(
        (1, 1, 1, 100, "2024-01-15 09:00:00"),
        (2, 1, 1, 50, "2024-01-15 10:00:00"),
        (3, 2, 1, 500, "2024-01-16 09:00:00"),
        (4, 1, 1, 200, "2024-01-18 09:00:00"),
    )
    assert both(star, metrics.cumulative_revenue, "date") == [
        ("A", date(2024, 1, 15), 1.5),
        ("B", date(2024, 1, 16), 5.0),
        ("A", date(2024, 1, 18), 3.5),
    ]


def test_trucks_with_one_name_merge_and_repeated_keys_fan_out(spark, fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 1, 200, NOON))
    same_name = star.truck.withColumn("truck_name", F.lit("A"))
    assert both(Star(star.fact, star.payment, same_name), metrics.revenue_by_truck) == [("A", 3.0)]
    doubled = Star(star.fact, star.payment, star.truck.unionByName(star.truck))
    assert sorted(both(doubled, metrics.truck_performance)) == [
        ("A", 2.0, 2, 1.0),
        ("B", 4.0, 2, 2.0),
    ]


def test_sales_without_a_match_vanish(fleet):
    star = fleet((1, 99, 1, 100, NOON), (2, 1, 99, 100, NOON), (3, None, 1, 5, NOON), (4, 1, 1, 1, NOON))
    assert [r["transaction_id"] for r in star_join(star).collect()] == [4]
    assert both(star, metrics.total_revenue) == [(0.01,)]


def test_selection(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 1, 200, NOON))
    sales = star_join(star)
    assert rows(selected(sales, [])) == []
    assert selected(sales, None).count() == 2
    narrowed = dashboard(as_measures(sales), as_measures(sales), ["B"])
    assert [r["truck_name"] for r in narrowed.payment_mix.collect()] == ["B"]
    assert narrowed.kpis.first()["worst_truck"] == "A"  # key figures ignore the selection


def test_dashboard_over_two_roll_ups(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 2, 300, NOON))
    with open_dashboard(star, ["A"]) as view:
        assert rows(view.names) == [("A",), ("B",)]
        assert rows(view.cumulative) == [("A", date(2024, 1, 15), 1.0)]
        assert rows(view.average_by_hour) == [("A", 12, 1.0)]
        assert view.kpis.first()["best_vs_average"] == 50.0
        kept = view.names.sparkSession
    assert kept.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_ids_of_one_name_do_not_add_rows_to_what_is_kept(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 2, 300, NOON))
    many = star.truck.withColumn("truck_name", F.lit("A"))
    kept = by_name(roll_up(Star(star.fact, star.payment, many), "date").drop("payment_method"))
    assert rows(kept) == [(date(2024, 1, 15), "A", 400, 2, 2)]


def test_previous_day_is_a_calendar_day(fleet):
    star = fleet(
        (1, 1, 1, 1, "2024-01-14 23:59:59.999999"),
        (2, 1, 1, 1, "2024-01-15 00:00:00"),
        (3, 1, 1, 1, "2024-01-15 23:59:59.999999"),
        (4, 1, 1, 1, "2024-01-16 00:00:00"),
    )
    found = previous_day(star.fact, date(2024, 1, 16)).select("transaction_id")
    assert sorted(rows(found)) == [(2,), (3,)]


def test_cleaning(facts):
    dirty = facts(
        (1, 1, 1, 100, NOON),
        (1, 1, 1, 100, NOON),
        (2, None, 1, 100, NOON),
        (3, 7, 1, 100, NOON),
        (4, 6, 2, 1, NOON),
        (5, 1, 3, 100, NOON),
        (6, 1, 1, 0, NOON),
        (7, 1, 1, 100, None),
    )
    ids = lambda df: sorted(r["transaction_id"] for r in df.collect())
    assert ids(clean_transactions(dirty)) == [1, 4]
    assert ids(clean_transactions(dirty, Validity(1, 7, (1, 3)))) == [1, 3, 5]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert rows(drop_nulls(df)) == [(1.0,)]


@pytest.mark.parametrize(
    ("function", "number", "text"),
    [
        (money, 5971.21, "£5,971.21"),
        (money, -1234567.5, "£-1,234,567.50"),
        (percent, 54.36, "54.4%"),
        (percent, 0.25, "0.2%"),
        (lambda c: percent(c, 2), 1234.5, "1234.50%"),
        (hourly_rate, 1281.871, "£1281.87/hour"),
    ],
)
def test_display_text(spark, function, number, text):
    assert value(spark, function(F.lit(number))) == text


def test_timestamp_text_cuts_to_seconds(spark):
    moment = F.lit(str(datetime(2025, 10, 25, 23, 58, 0, 999999))).cast("timestamp_ntz")
    assert value(spark, timestamp_text(moment)) == "2025-10-25 23:58:00"


def test_kpis(fleet):
    star = fleet((1, 1, 1, 100, NOON), (2, 2, 1, 300, NOON), (3, 3, 1, 200, NOON))
    assert both(star, kpi_metrics) == [("B", 3.0, 50.0, "A", 1.0, -50.0, 2.0)]


def test_known_report_arithmetic(fleet):
    """A published day: segment revenues add up to the total and to these shares."""
    star = fleet(
        *[(i, 1, 1, 500, NOON) for i in range(345)], (1000, 1, 1, 272, NOON),
        *[(2000 + i, 2, 2, 1000, NOON) for i in range(368)], (3000, 2, 2, 1028 - 500, NOON),
        (3001, 2, 2, 500 + 1, NOON), (3002, 3, 1, 55321 - 1, NOON),
    )
    segments = {r[0]: r for r in both(star, metrics.price_segmentation, "price_segment")}
    total = both(star, metrics.total_revenue)[0][0]
    assert total == pytest.approx(sum(r[2] for r in segments.values()))
    assert segments[LOW][2] == 1727.72
    assert segments[LOW][4] == pytest.approx(100 * 1727.72 / total)


def test_times_mean_the_same_in_every_session_zone(spark, facts, lake):
    """02:30 on that day does not exist in New York."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    sale = (1, 1, 1, 100, "2024-03-10 02:30:00.000001")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        fact = facts(sale)
        seen = fact.select(
            hour_of_day(F.col("at")), sale_date(F.col("at")), timestamp_text(F.col("at")),
            day_text(sale_date(F.col("at"))),
        ).first()
        assert tuple(seen) == (2, date(2024, 3, 10), "2024-03-10 02:30:00", "2024-03-10")
        path = new_folder(spark, "csv")
        write_csv(fact, path)
        assert rows(read_csv(spark, path, TRANSACTION)) == rows(fact)
        write_transactions(fact, lake, "overwrite")
        landed = previous_day(read_transactions(spark, lake), date(2024, 3, 11))
        assert landed.first()["at"] == at(sale[4])
        write_mark(spark, lake, at(sale[4]))
        assert read_mark(spark, lake, "2020-01-01").first()["mark"] == at(sale[4])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
