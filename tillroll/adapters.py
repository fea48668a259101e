"""The sample tables seen as stars."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tillroll.schemas import Star

# Columns the stars use, as the files hold them; declaring them saves a job per table
# that would read footers only to learn the types.
EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
    ]
)
LINEITEM = StructType(
    [
        StructField("l_orderkey", LongType()),
        StructField("l_suppkey", LongType()),
        StructField("l_linenumber", IntegerType()),
        StructField("l_extendedprice", DoubleType()),
        StructField("l_discount", DoubleType()),
        StructField("l_returnflag", StringType()),
        StructField("l_linestatus", StringType()),
        StructField("l_shipdate", TimestampNTZType()),
    ]
)
CUSTOMER = StructType(
    [StructField("c_custkey", LongType()), StructField("c_nationkey", IntegerType())]
)
SUPPLIER = StructType(
    [
        StructField("s_suppkey", LongType()),
        StructField("s_name", StringType()),
        StructField("s_nationkey", IntegerType()),
    ]
)
NATION = StructType(
    [
        StructField("n_nationkey", IntegerType()),
        StructField("n_name", StringType()),
        StructField("n_regionkey", IntegerType()),
    ]
)
_SCHEMAS = {
    "customer": CUSTOMER,
    "events": EVENTS,
    "lineitem": LINEITEM,
    "nation": NATION,
    "supplier": SUPPLIER,
}

# Surrogate ids of the payment methods in the sample tables.
EVENT_METHODS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
FLAG_METHODS = {"A": 1, "R": 2, "N": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def method_id(method: str, known: Mapping[str, int]) -> str:
    """SQL for the id of a payment method, worked out per row so the fact needs no look-up.
    A method outside the list gets 60 bits of its digest and is treated like any other."""
    cases = " ".join(f"WHEN '{name}' THEN {number}L" for name, number in known.items())
    return (
        f"CASE {method} {cases} ELSE CAST(conv(substr(md5({method}), 1, 15), 16, 10) AS BIGINT) END"
    )


def _payment(source: DataFrame, method: str, known: Mapping[str, int]) -> DataFrame:
    methods = source.selectExpr(f"{method} AS payment_method").distinct()
    return methods.where("payment_method IS NOT NULL").selectExpr(
        f"{method_id('payment_method', known)} AS payment_method_id", "payment_method"
    )


def events_fact(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS transaction_id",
        "user_id AS truck_id",
        f"{method_id('event_type', EVENT_METHODS)} AS payment_method_id",
        "CAST(rint(value * 100) AS BIGINT) AS total",
        "ts AS at",
    )


def events_star(spark: SparkSession, sf_dir: str) -> Star:
    """Events are sales, customers are trucks named after their nation, the event type is
    the payment method. Has every hour of thirty days."""
    events = table(spark, sf_dir, "events")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    truck = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return Star(
        events_fact(events),
        _payment(events, "event_type", EVENT_METHODS),
        truck.selectExpr("c_custkey AS truck_id", "n_name AS truck_name", *_ratings("c_nationkey")),
    )


def _ratings(nation: str) -> tuple[str, str]:
    """Stand-ins for what the sample tables do not have."""
    return (
        f"CAST({nation} % 2 AS BIGINT) AS has_card_reader",
        "CAST(n_regionkey + 1 AS BIGINT) AS fsa_rating",
    )


_TOTAL = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
# A ten-thousandth of the price, so that there are sales in every price segment.
CHEAP_TOTAL = "CAST(floor(l_extendedprice / 100) AS BIGINT)"


def _lineitem_fact(lineitem: DataFrame, truck_id: str, total: str = _TOTAL) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS transaction_id",
        f"{truck_id} AS truck_id",
        f"{method_id('l_returnflag', FLAG_METHODS)} AS payment_method_id",
        f"{total} AS total",
        "l_shipdate AS at",
    )


def supplier_star(spark: SparkSession, sf_dir: str, total: str = _TOTAL) -> Star:
    """Line items are sales, suppliers are trucks under their own name, the return flag is
    the payment method. The largest fact and a fleet that grows with it; dates only."""
    lineitem = table(spark, sf_dir, "lineitem")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    truck = table(spark, sf_dir, "supplier").join(nation, "s_nationkey")
    return Star(
        _lineitem_fact(lineitem, "l_suppkey", total),
        _payment(lineitem, "l_returnflag", FLAG_METHODS),
        truck.selectExpr("s_suppkey AS truck_id", "s_name AS truck_name", *_ratings("s_nationkey")),
    )


def raw_star(spark: SparkSession, sf_dir: str) -> Star:
    """Line items as an uncleaned source of a seven-truck fleet.

    The line number is the truck. Undiscounted rows have lost their truck, 5,000 pounds
    are taken off so that some totals are not positive, and accepted rows already shipped
    (flag A, status F) are delivered twice.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    again = lineitem.where("l_returnflag = 'A' AND l_linestatus = 'F'")
    return Star(
        _lineitem_fact(
            lineitem.unionByName(again),
            "CASE WHEN l_discount <> 0 THEN CAST(l_linenumber AS BIGINT) END",
            f"{_TOTAL} - 500000",
        ),
        _payment(lineitem, "l_returnflag", FLAG_METHODS),
        table(spark, sf_dir, "nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS truck_id",
            "n_name AS truck_name",
            *_ratings("n_nationkey"),
        ),
    )


def raw_events_star(spark: SparkSession, sf_dir: str) -> Star:
    """The events star as an uncleaned source: errors have lost their truck, 5 pounds are
    taken off so that some totals are not positive, and clicks are delivered twice."""
    star = events_star(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    delivered = events_fact(events.unionByName(events.where("event_type = 'click'")))
    damaged = delivered.selectExpr(
        "transaction_id",
        f"CASE WHEN payment_method_id <> {EVENT_METHODS['error']} THEN truck_id END AS truck_id",
        "payment_method_id",
        "total - 500 AS total",
        "at",
    )
    return replace(star, fact=damaged)
