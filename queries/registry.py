"""One query per operator: a function of the session and the folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from queries.settings import (
    AS_OF,
    DAY,
    EVENTS_CUTOFF,
    FIRST_CUSTOMER,
    LAST_CUSTOMER,
    LOOK_BACK,
    SECOND_LOAD,
    SELECTED,
    TRUCK,
    VALID_METHODS,
)
from tillroll.adapters import (
    CHEAP_TOTAL,
    EVENT_METHODS,
    EVENTS,
    events_fact,
    events_star,
    raw_events_star,
    raw_star,
    supplier_star,
    table,
)
from tillroll.functions import (
    as_timestamp,
    day_text,
    hour_of_day,
    hourly_rate,
    money,
    percent,
    pounds,
    price_segment,
    sale_date,
    timestamp_text,
    with_partition_columns,
)
from tillroll.operators import metrics, ranking
from tillroll.operators.clean import (
    Validity,
    clean_transactions,
    drop_nulls,
    drop_repeats,
    valid_rows,
)
from tillroll.operators.filters import previous_day
from tillroll.operators.star import on_previous_day, roll_up, star_join
from tillroll.plans import dashboard, load, report
from tillroll.schemas import PAYMENT, TRANSACTION, TRUCK as TRUCK_SCHEMA
from tillroll.sources import (
    Lake,
    TableSource,
    compact,
    new_folder,
    read_csv,
    read_csv_checked,
    read_dimension,
    read_lake,
    read_mark,
    read_table,
    read_transactions,
    refresh_summary,
    register_lake,
    write_csv,
    write_dimension,
    write_mark,
    write_transactions,
)
from tillroll.sources.shared import stage
from tillroll.sources.tables import after, up_to
from tillroll.streaming.landing import land_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    return named(function.__name__)(function)


def named(name: str) -> Callable[[Query], Query]:
    """Register under a name that is taken in this module."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _new_lake(spark: SparkSession) -> Lake:
    return Lake(new_folder(spark, "lake"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_star(spark, sf_dir).fact


# --- sources ---------------------------------------------------------------------------


def _scan(spark: SparkSession, table: DataFrame, schema: StructType) -> DataFrame:
    """A sample table as a source of its own, a folder with one column too many, read as any
    other source is."""
    path = new_folder(spark, "source")
    table.withColumn("source_row", F.monotonically_increasing_id()).write.parquet(path)
    return read_table(spark, TableSource("parquet", path), schema)


@query
def scan_payment_dim(spark, sf_dir):
    return _scan(spark, events_star(spark, sf_dir).payment, PAYMENT)


@query
def scan_truck_dim(spark, sf_dir):
    return _scan(spark, events_star(spark, sf_dir).truck, TRUCK_SCHEMA)


@query
def scan_history(spark, sf_dir):
    return _scan(spark, _events(spark, sf_dir), TRANSACTION).where(up_to(EVENTS_CUTOFF))


@query
def scan_increment(spark, sf_dir):
    return _scan(spark, _events(spark, sf_dir), TRANSACTION).where(after(EVENTS_CUTOFF))


@query
def hwm_read(spark, sf_dir):
    lake = _new_lake(spark)
    history = load.profile(_events(spark, sf_dir).where(up_to(EVENTS_CUTOFF)))
    write_mark(spark, lake, history.latest)
    return read_mark(spark, lake, EVENTS_CUTOFF)


@query
def hwm_update(spark, sf_dir):
    lake = _new_lake(spark)
    write_mark(spark, lake, datetime.fromisoformat(EVENTS_CUTOFF))
    increment = load.profile(_events(spark, sf_dir).where(after(EVENTS_CUTOFF)))
    write_mark(spark, lake, increment.latest)
    return read_mark(spark, lake, EVENTS_CUTOFF)


@query
def csv_roundtrip(spark, sf_dir):
    path = new_folder(spark, "csv")
    write_csv(_events(spark, sf_dir), path)
    return read_csv(spark, path, TRANSACTION)


@query
def csv_quarantine(spark, sf_dir):
    """Sales as text; totals of errors are no numbers, and signups have no time."""
    path, method = new_folder(spark, "csv"), F.col("payment_method_id")
    total = F.when(method == EVENT_METHODS["error"], "n/a").otherwise(F.col("total").cast("string"))
    at = F.when(method == EVENT_METHODS["signup"], "soon").otherwise(F.col("at").cast("string"))
    write_csv(_events(spark, sf_dir).withColumns({"total": total, "at": at}), path)
    good, rejected = read_csv_checked(spark, path, TRANSACTION)
    landed = good.select("transaction_id", "total", F.lit(None).cast("string").alias("reason"))
    number = F.split("line", ",")[0].cast("bigint").alias("transaction_id")
    return landed.union(rejected.select(number, F.lit(None).cast("bigint"), "reason"))


_DATABASE = "tillroll_sample"


def _registered_lake(spark, sf_dir) -> str:
    lake = _new_lake(spark)
    star = events_star(spark, sf_dir)
    write_transactions(star.fact, lake, "overwrite")
    write_dimension(star.payment, lake, "payment")
    write_dimension(star.truck, lake, "truck")
    spark.sql(f"DROP DATABASE IF EXISTS {_DATABASE} CASCADE")
    register_lake(spark, lake, _DATABASE)
    return _DATABASE


@query
def catalog_scan(spark, sf_dir):
    database = _registered_lake(spark, sf_dir)
    return spark.table(f"{database}.transaction_table")


@query
def catalog_partitions(spark, sf_dir):
    database = _registered_lake(spark, sf_dir)
    return spark.sql(f"SHOW PARTITIONS {database}.transaction_table")


# --- sinks -----------------------------------------------------------------------------


@query
def sink_partitioned_overwrite(spark, sf_dir):
    lake, fact = _new_lake(spark), _events(spark, sf_dir)
    write_transactions(fact.where(up_to(EVENTS_CUTOFF)), lake, "overwrite")
    write_transactions(fact, lake, "overwrite")
    return read_transactions(spark, lake)


@query
def sink_partitioned_append(spark, sf_dir):
    lake, fact = _new_lake(spark), _events(spark, sf_dir)
    write_transactions(fact.where(up_to(EVENTS_CUTOFF)), lake, "overwrite")
    write_transactions(fact.where(after(EVENTS_CUTOFF)), lake, "append")
    return read_transactions(spark, lake)


@query
def sink_dimension_overwrite(spark, sf_dir):
    lake, truck = _new_lake(spark), events_star(spark, sf_dir).truck
    write_dimension(truck, lake, "truck")
    write_dimension(truck, lake, "truck")
    return read_dimension(spark, lake, "truck")


@query
def sink_compacted(spark, sf_dir):
    """Every day arrives in three loads and is put together."""
    lake, fact = _new_lake(spark), _events(spark, sf_dir)
    hour = hour_of_day(F.col("at"))
    for part in (hour < 6, (hour >= 6) & (hour < 18), hour >= 18):
        write_transactions(fact.where(part), lake, "append")
    compact(spark, lake)
    return read_transactions(spark, lake)


# --- cleaning --------------------------------------------------------------------------


@query
def clean_drop_nulls(spark, sf_dir):
    return drop_nulls(raw_star(spark, sf_dir).fact)


@query
def clean_dedupe(spark, sf_dir):
    return drop_repeats(raw_star(spark, sf_dir).fact)


@query
def clean_validity(spark, sf_dir):
    return valid_rows(raw_star(spark, sf_dir).fact)


@named("clean_transactions")
def clean_transactions_job(spark, sf_dir):
    return clean_transactions(raw_star(spark, sf_dir).fact)


# --- derived columns -------------------------------------------------------------------


@query
def derive_timestamp(spark, sf_dir):
    fact = _events(spark, sf_dir)
    texts = fact.select("transaction_id", F.col("at").cast("string").alias("text"))
    return texts.select("transaction_id", as_timestamp(F.col("text")).alias("at"))


@query
def derive_partitions(spark, sf_dir):
    fact = _events(spark, sf_dir).select("transaction_id", "at")
    return with_partition_columns(fact)


@query
def derive_pounds(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id", pounds(F.col("total")).alias("total_pounds")
    )


@query
def derive_date(spark, sf_dir):
    return _events(spark, sf_dir).select("transaction_id", sale_date(F.col("at")).alias("date"))


@query
def derive_hour(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id", hour_of_day(F.col("at")).alias("hour_of_day")
    )


@named("price_segment")
def price_segment_of_sale(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id", "total", price_segment(F.col("total")).alias("price_segment")
    )


# --- filters and joins -----------------------------------------------------------------


@query
def filter_previous_day(spark, sf_dir):
    return previous_day(_events(spark, sf_dir), AS_OF)


@query
def filter_selected_trucks(spark, sf_dir):
    sales = roll_up(events_star(spark, sf_dir), "date")
    return metrics.cumulative_revenue(sales, SELECTED)


@query
def selected_payment_distribution(spark, sf_dir):
    return metrics.payment_distribution(roll_up(events_star(spark, sf_dir)), SELECTED)


@query
def selected_avg_amount_by_hour(spark, sf_dir):
    sales = roll_up(events_star(spark, sf_dir), "hour_of_day")
    return metrics.average_amount_by_hour(sales, SELECTED)


@named("star_join")
def star_join_rows(spark, sf_dir):
    return star_join(events_star(spark, sf_dir))


@query
def star_join_previous_day(spark, sf_dir):
    return star_join(on_previous_day(events_star(spark, sf_dir), AS_OF))


# --- measures, windows, rankings -------------------------------------------------------


def _measure(name: str, operator: Callable[[DataFrame], DataFrame], *grains: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(roll_up(events_star(spark, sf_dir), *grains))


_measure("revenue_by_truck", metrics.revenue_by_truck)
_measure("daily_revenue", metrics.daily_revenue, "date")
_measure("payment_distribution", metrics.payment_distribution)
_measure("avg_amount_by_hour", metrics.average_amount_by_hour, "hour_of_day")
_measure("revenue_velocity", metrics.revenue_velocity, "hour_of_day")
_measure("truck_performance", metrics.truck_performance)
_measure("total_revenue", metrics.total_revenue)
_measure("revenue_for_truck", lambda sales: metrics.revenue_for_truck(sales, TRUCK))
_measure("average_truck_revenue", metrics.average_truck_revenue)
_measure("underperforming_trucks", metrics.underperforming_trucks)
_measure("distinct_trucks", metrics.distinct_trucks)
_measure("cumulative_revenue", metrics.cumulative_revenue, "date")
_measure("price_segmentation", metrics.price_segmentation, "price_segment")
_measure("best_truck", ranking.best_truck)
_measure("worst_truck", ranking.worst_truck)
_measure("top_segment_by_count", ranking.top_segment_by_count, "price_segment")
_measure("top_segment_by_revenue", ranking.top_segment_by_revenue, "price_segment")
_measure("kpi_metrics", dashboard.kpi_metrics)


@query
def increment_stats(spark, sf_dir):
    return load.increment_stats(_events(spark, sf_dir).where(after(EVENTS_CUTOFF)))


def _supplier_measure(name: str, operator, *grains: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(roll_up(supplier_star(spark, sf_dir), *grains))


_supplier_measure("supplier_revenue", metrics.revenue_by_truck)
_supplier_measure("supplier_daily_revenue", metrics.daily_revenue, "date")
_supplier_measure("supplier_cumulative_revenue", metrics.cumulative_revenue, "date")
_supplier_measure("supplier_payment_distribution", metrics.payment_distribution)
_supplier_measure("supplier_performance", metrics.truck_performance)
_supplier_measure("supplier_underperforming", metrics.underperforming_trucks)
_supplier_measure("supplier_kpi_metrics", dashboard.kpi_metrics)


@query
def supplier_price_segmentation(spark, sf_dir):
    """With prices so low that all segments occur."""
    star = supplier_star(spark, sf_dir, total=CHEAP_TOTAL)
    return metrics.price_segmentation(roll_up(star, "price_segment"))


@query
def supplier_star_join(spark, sf_dir):
    return star_join(supplier_star(spark, sf_dir))


# --- text ------------------------------------------------------------------------------


@query
def format_timestamp(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "transaction_id",
        timestamp_text(F.col("at")).alias("at_text"),
        day_text(sale_date(F.col("at"))).alias("day_text"),
    )


@query
def format_money(spark, sf_dir):
    amount = pounds(F.col("total"))
    return _events(spark, sf_dir).select(
        "transaction_id",
        money(amount).alias("money_text"),
        percent(amount, 1).alias("percent_text"),
        percent(amount / 3, 2).alias("fine_percent_text"),
        hourly_rate(amount / 7).alias("rate_text"),
    )


# --- jobs ------------------------------------------------------------------------------


_RULE = Validity(FIRST_CUSTOMER, LAST_CUSTOMER, VALID_METHODS)


@query
def initial_load(spark, sf_dir):
    lake = _new_lake(spark)
    load.initial_load(raw_events_star(spark, sf_dir), lake, EVENTS_CUTOFF, _RULE)
    return read_transactions(spark, lake)


def _loaded(spark, sf_dir, rule: Validity | None) -> Lake:
    """History, an increment, and all increments again after the mark went back, as after a
    restore of the source: half of the last load is in the lake already."""
    lake, star = _new_lake(spark), raw_events_star(spark, sf_dir)
    load.initial_load(star, lake, EVENTS_CUTOFF, _RULE)
    first = star.fact.where(up_to(SECOND_LOAD))
    load.incremental_load(first, lake, EVENTS_CUTOFF, rule)
    write_mark(spark, lake, datetime.fromisoformat(EVENTS_CUTOFF))
    load.incremental_load(star.fact, lake, EVENTS_CUTOFF, rule)
    return lake


@query
def incremental_load(spark, sf_dir):
    return read_transactions(spark, _loaded(spark, sf_dir, None))


@query
def incremental_load_cleaned(spark, sf_dir):
    return read_transactions(spark, _loaded(spark, sf_dir, _RULE))


@query
def incremental_load_late(spark, sf_dir):
    """Purchases of the days before the second load arrive after it, within the look-back."""
    lake, star = _new_lake(spark), events_star(spark, sf_dir)
    late = F.col("payment_method_id") == EVENT_METHODS["purchase"]
    load.initial_load(star, lake, EVENTS_CUTOFF, None)
    load.incremental_load(star.fact.where(up_to(SECOND_LOAD)).where(~late), lake, EVENTS_CUTOFF)
    load.incremental_load(star.fact, lake, EVENTS_CUTOFF, look_back=LOOK_BACK)
    return read_transactions(spark, lake)


@query
def dashboard_from_summary(spark, sf_dir):
    """History and two increments that overlap; the dashboard reads the sums of each load."""
    lake, star = _new_lake(spark), events_star(spark, sf_dir)
    load.initial_load(star, lake, EVENTS_CUTOFF, None)
    refresh_summary(spark, lake)
    load.incremental_load(star.fact.where(up_to(SECOND_LOAD)), lake, EVENTS_CUTOFF)
    refresh_summary(spark, lake)
    load.incremental_load(star.fact, lake, EVENTS_CUTOFF, look_back=LOOK_BACK)
    with dashboard.open_lake_dashboard(spark, lake, SELECTED) as view:
        return stage(dashboard.dashboard_lines(view))


@query
def dashboard_view(spark, sf_dir):
    with dashboard.open_dashboard(events_star(spark, sf_dir), SELECTED) as view:
        return stage(dashboard.dashboard_lines(view))


@query
def daily_report(spark, sf_dir):
    return report.daily_report(events_star(spark, sf_dir), AS_OF)


@query
def daily_report_from_lake(spark, sf_dir):
    lake, star = _new_lake(spark), events_star(spark, sf_dir)
    write_transactions(star.fact, lake, "overwrite")
    write_dimension(star.payment, lake, "payment")
    write_dimension(star.truck, lake, "truck")
    return report.daily_report(read_lake(spark, lake, [DAY]), AS_OF)


@query
def stream_incremental_load(spark, sf_dir):
    """Files of events land in several batches, and those of one kind are delivered twice."""
    lake, folder = _new_lake(spark), new_folder(spark, "drop")
    events = table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(folder)
    events.where("event_type = 'click'").coalesce(1).write.mode("append").parquet(folder)
    checkpoint = new_folder(spark, "landing")
    landing = land_stream(
        spark, folder, lake, checkpoint, schema=EVENTS, to_fact=events_fact, maxFilesPerTrigger="2"
    )
    landing.awaitTermination()
    return read_transactions(spark, lake)
