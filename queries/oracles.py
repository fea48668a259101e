"""The registered queries as ANSI SQL over the same tables.

Written from the meaning of each query, not from its Spark form: sums run over joined
sales, distinct hours are counted, percentiles use `quantile_cont`.
"""

from __future__ import annotations

from queries.settings import (
    DAY,
    EVENTS_CUTOFF,
    FIRST_CUSTOMER,
    LAST_CUSTOMER,
    SELECTED,
    TRUCK,
    VALID_METHODS,
)


def _method(column: str, known: str) -> str:
    return (
        f"CASE {known} ELSE ('0x' || substr(md5({column}), 1, 15))::BIGINT END"
    )


_EVENT_METHOD = _method(
    "event_type",
    "WHEN event_type IS NULL THEN NULL WHEN event_type = 'click' THEN 1 "
    "WHEN event_type = 'error' THEN 2 WHEN event_type = 'purchase' THEN 3 "
    "WHEN event_type = 'signup' THEN 4 WHEN event_type = 'view' THEN 5",
)
_FLAG_METHOD = _method(
    "l_returnflag",
    "WHEN l_returnflag IS NULL THEN NULL WHEN l_returnflag = 'A' THEN 1 "
    "WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'N' THEN 3",
)

_SALES = """sales AS (
  SELECT transaction_id, truck_name, payment_method, total / 100 AS total_pounds, "at",
         has_card_reader, fsa_rating, total
  FROM fact JOIN payment USING (payment_method_id) JOIN truck USING (truck_id))"""

_EVENTS = f"""fact AS (
  SELECT event_id AS transaction_id, user_id AS truck_id,
         {_EVENT_METHOD} AS payment_method_id,
         CAST(round(value * 100) AS BIGINT) AS total, ts AS "at"
  FROM events),
payment AS (
  SELECT DISTINCT {_EVENT_METHOD} AS payment_method_id, event_type AS payment_method
  FROM events WHERE event_type IS NOT NULL),
truck AS (
  SELECT c_custkey AS truck_id, n_name AS truck_name,
         CAST(c_nationkey % 2 AS BIGINT) AS has_card_reader,
         CAST(n_regionkey + 1 AS BIGINT) AS fsa_rating
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_SUPPLIERS = f"""fact AS (
  SELECT l_orderkey AS transaction_id, l_suppkey AS truck_id,
         {_FLAG_METHOD} AS payment_method_id,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS total, l_shipdate AS "at"
  FROM lineitem),
payment AS (
  SELECT DISTINCT {_FLAG_METHOD} AS payment_method_id, l_returnflag AS payment_method
  FROM lineitem WHERE l_returnflag IS NOT NULL),
truck AS (
  SELECT s_suppkey AS truck_id, s_name AS truck_name,
         CAST(s_nationkey % 2 AS BIGINT) AS has_card_reader,
         CAST(n_regionkey + 1 AS BIGINT) AS fsa_rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_RAW_LINE = f"""l_orderkey AS transaction_id,
         CASE WHEN l_discount <> 0 THEN CAST(l_linenumber AS BIGINT) END AS truck_id,
         {_FLAG_METHOD} AS payment_method_id,
         CAST(round(l_extendedprice * 100) AS BIGINT) - 500000 AS total,
         l_shipdate AS "at" """
_RAW_EVENT = f"""event_id AS transaction_id,
         CASE WHEN event_type <> 'error' THEN user_id END AS truck_id,
         {_EVENT_METHOD} AS payment_method_id,
         CAST(round(value * 100) AS BIGINT) - 500 AS total, ts AS "at" """


def _raw(columns: str, source: str, repeated: str, trucks: str, methods: str) -> str:
    return f"""fact AS (
  SELECT {columns} FROM {source} UNION ALL
  SELECT {columns} FROM {source} WHERE {repeated}),
valid AS (
  SELECT * FROM fact WHERE total > 0 AND truck_id BETWEEN {trucks}
  AND payment_method_id IN ({methods})),
clean AS (
  SELECT DISTINCT * FROM valid
  WHERE transaction_id IS NOT NULL AND "at" IS NOT NULL)"""


_RAW_LINES = _raw(
    _RAW_LINE,
    "lineitem",
    "l_returnflag = 'A' AND l_linestatus = 'F'",
    "1 AND 6",
    "1, 2",
)
_RAW_EVENTS = _raw(
    _RAW_EVENT,
    "events",
    "event_type = 'click'",
    f"{FIRST_CUSTOMER} AND {LAST_CUSTOMER}",
    ", ".join(map(str, VALID_METHODS)),
)

_PARTS = """CAST(year("at") AS INTEGER) AS "year", CAST(month("at") AS INTEGER) AS "month",
  CAST(day("at") AS INTEGER) AS "day" """

_SEGMENT = """CASE WHEN total <= 500 THEN 'Low (£0-5)' WHEN total <= 1000
  THEN 'Medium (£5-10)' ELSE 'High (£10+)' END"""
_RANK = """CASE price_segment WHEN 'Low (£0-5)' THEN 1 WHEN 'Medium (£5-10)' THEN 2
  ELSE 3 END"""

_PER_TRUCK = """per_truck AS (
  SELECT truck_name, CAST(coalesce(sum(total), 0) AS BIGINT) AS pence,
         count(transaction_id) AS n
  FROM sales WHERE truck_name IS NOT NULL GROUP BY truck_name)"""
_SEGMENTS = f"""segments AS (
  SELECT price_segment, count(transaction_id) AS transaction_id,
         CAST(coalesce(sum(total), 0) AS BIGINT) AS pence
  FROM (SELECT *, {_SEGMENT} AS price_segment FROM sales) GROUP BY price_segment),
shares AS (
  SELECT price_segment, transaction_id, pence / 100 AS total_pounds,
         transaction_id / CAST(sum(transaction_id) OVER () AS BIGINT) * 100
           AS percentage_of_transactions,
         pence / CAST(sum(pence) OVER () AS BIGINT) * 100 AS percentage_of_revenue
  FROM segments)"""

_ON_DAY = f"""CAST("at" AS DATE) = DATE '{DAY}'"""
_NAMES = ", ".join(f"'{name}'" for name in SELECTED)
_IN_NAMES = f"truck_name IN ({_NAMES})"
_MARK = f"TIMESTAMP '{EVENTS_CUTOFF}'"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _fact(columns: str, where: str = "TRUE") -> str:
    return _with(_EVENTS) + f"SELECT {columns} FROM fact WHERE {where}"


def _metrics(star: str) -> dict[str, str]:
    sales = _with(star, _SALES)
    trucks = _with(star, _SALES, _PER_TRUCK)
    segments = _with(star, _SALES, _SEGMENTS)
    daily = """SELECT truck_name, CAST("at" AS DATE) AS date,
      CAST(coalesce(sum(total), 0) AS BIGINT) AS pence
      FROM sales WHERE truck_name IS NOT NULL AND "at" IS NOT NULL GROUP BY ALL"""
    return {
        "revenue_by_truck": trucks + "SELECT truck_name, pence / 100 AS total_pounds FROM per_truck",
        "daily_revenue": sales
        + f"SELECT truck_name, date, pence / 100 AS total_pounds FROM ({daily})",
        "cumulative_revenue": sales
        + f"""SELECT truck_name, date, CAST(sum(pence) OVER (PARTITION BY truck_name
          ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) / 100
          AS cumulative_total_pounds FROM ({daily})""",
        "payment_distribution": sales
        + """SELECT truck_name, payment_method, count(transaction_id) AS "count" FROM sales
          WHERE truck_name IS NOT NULL AND payment_method IS NOT NULL GROUP BY ALL""",
        "avg_amount_by_hour": sales
        + """SELECT truck_name, CAST(hour("at") AS INTEGER) AS hour_of_day,
          CAST(sum(total) AS BIGINT) / count(total) / 100 AS average_transaction_amount
          FROM sales WHERE truck_name IS NOT NULL AND "at" IS NOT NULL GROUP BY ALL""",
        "revenue_velocity": sales
        + """SELECT truck_name, CAST(coalesce(sum(total), 0) AS BIGINT)
          / count(DISTINCT hour("at")) / 100 AS avg_revenue_per_hour FROM sales
          WHERE truck_name IS NOT NULL AND "at" IS NOT NULL GROUP BY truck_name""",
        "truck_performance": trucks
        + """SELECT truck_name, pence / 100 AS total_pounds, n AS transaction_id,
          pence / 100 / nullif(n, 0) AS revenue_per_transaction FROM per_truck""",
        "total_revenue": sales
        + """SELECT CAST(coalesce(sum(total), 0) AS BIGINT) / 100 AS total_pounds FROM sales""",
        "revenue_for_truck": sales
        + f"""SELECT CAST(coalesce(sum(total), 0) AS BIGINT) / 100 AS total_pounds
          FROM sales WHERE truck_name = '{TRUCK}'""",
        "average_truck_revenue": trucks
        + """SELECT CAST(sum(pence) AS BIGINT) / count(*) / 100 AS average_revenue
          FROM per_truck""",
        "underperforming_trucks": trucks
        + """SELECT truck_name, pence / 100 AS total_pounds, n AS transaction_id,
          pence / 100 / nullif(n, 0) AS revenue_per_transaction FROM per_truck
          WHERE pence < (SELECT quantile_cont(pence, 0.25) FROM per_truck)""",
        "distinct_trucks": sales + "SELECT DISTINCT truck_name FROM sales",
        "price_segmentation": segments + "SELECT * FROM shares",
        "best_truck": trucks
        + """SELECT truck_name, pence / 100 AS total_pounds FROM per_truck
          ORDER BY pence DESC, truck_name LIMIT 1""",
        "worst_truck": trucks
        + """SELECT truck_name, pence / 100 AS total_pounds FROM per_truck
          ORDER BY pence, truck_name LIMIT 1""",
        "top_segment_by_count": segments
        + f"SELECT * FROM shares ORDER BY transaction_id DESC, {_RANK} LIMIT 1",
        "top_segment_by_revenue": segments
        + f"SELECT * FROM shares ORDER BY percentage_of_revenue DESC, {_RANK} LIMIT 1",
        "kpi_metrics": trucks
        + """SELECT best_truck, best_revenue,
          CASE WHEN average_revenue = 0 THEN 0.0::DOUBLE
            ELSE (best_revenue - average_revenue) / average_revenue * 100 END AS best_vs_average,
          worst_truck, worst_revenue,
          CASE WHEN average_revenue = 0 THEN 0.0::DOUBLE
            ELSE (worst_revenue - average_revenue) / average_revenue * 100 END
            AS worst_vs_average,
          average_revenue
          FROM (SELECT truck_name AS best_truck, pence / 100 AS best_revenue FROM per_truck
                ORDER BY pence DESC, truck_name LIMIT 1),
               (SELECT truck_name AS worst_truck, pence / 100 AS worst_revenue
                FROM per_truck ORDER BY pence, truck_name LIMIT 1),
               (SELECT CAST(sum(pence) AS BIGINT) / count(*) / 100 AS average_revenue
                FROM per_truck)""",
        "star_join": sales + "SELECT * FROM sales",
    }


_EVENTS_LAKE = _with(_EVENTS) + f"SELECT *, {_PARTS} FROM fact"

_REPORT = (
    _with(
        _EVENTS,
        _SALES.replace("sales AS", "every_sale AS", 1),
        f"sales AS (SELECT * FROM every_sale WHERE {_ON_DAY})",
        _PER_TRUCK,
        _SEGMENTS,
    )
    + f"""SELECT *, DATE '{DAY}' AS report_date FROM (
SELECT 1 AS section_no, 'summary' AS section, 1.0::DOUBLE AS sort_key,
  'total revenue' AS label, CAST(sum(total) AS BIGINT) / 100 AS value,
  CAST(NULL AS DOUBLE) AS pct, format('£{{:,.2f}}', CAST(sum(total) AS BIGINT) / 100) AS display
FROM sales
UNION ALL
SELECT 1, 'summary', 2.0::DOUBLE, 'most demanded segment: ' || price_segment,
  CAST(transaction_id AS DOUBLE), percentage_of_transactions,
  format('{{:.1f}}% of transactions', percentage_of_transactions)
FROM (SELECT * FROM shares ORDER BY transaction_id DESC, {_RANK} LIMIT 1)
UNION ALL
SELECT 1, 'summary', 3.0::DOUBLE, 'best truck: ' || truck_name, pence / 100, NULL,
  format('£{{:,.2f}}', pence / 100)
FROM (SELECT * FROM per_truck ORDER BY pence DESC, truck_name LIMIT 1)
UNION ALL
SELECT 1, 'summary', 4.0::DOUBLE, 'worst truck: ' || truck_name, pence / 100, NULL,
  format('£{{:,.2f}}', pence / 100)
FROM (SELECT * FROM per_truck ORDER BY pence, truck_name LIMIT 1)
UNION ALL
SELECT 2, 'underperformers', CAST(pence AS DOUBLE), truck_name, pence / 100, NULL,
  format('£{{:,.2f}}', pence / 100)
FROM per_truck WHERE pence < (SELECT quantile_cont(pence, 0.25) FROM per_truck)
UNION ALL
SELECT 3, 'velocity', -rate, truck_name, rate / 100, NULL,
  format('£{{:.2f}}/hour', rate / 100)
FROM (SELECT truck_name, CAST(sum(total) AS BIGINT) / count(DISTINCT hour("at")) AS rate
      FROM sales WHERE truck_name IS NOT NULL GROUP BY truck_name)
UNION ALL
SELECT 4, 'segments', CAST({_RANK} AS DOUBLE), price_segment, total_pounds,
  percentage_of_revenue,
  format('£{{:,.2f}}, {{:.1f}}%', total_pounds, percentage_of_revenue)
FROM shares
UNION ALL
SELECT 5, 'insights', 1.0::DOUBLE, 'dominant segment: ' || price_segment, total_pounds,
  percentage_of_revenue, format('{{:.1f}}% of revenue', percentage_of_revenue)
FROM (SELECT * FROM shares ORDER BY percentage_of_revenue DESC, {_RANK} LIMIT 1))"""
)


def _selected(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE {_IN_NAMES}"


def _dashboard(of: dict[str, str]) -> str:
    """The frames of the dashboard as lines, the charts narrowed to the selection."""
    parts = (
        ("best", of["kpi_metrics"], "best_truck", "NULL", "best_revenue"),
        ("worst", of["kpi_metrics"], "worst_truck", "NULL", "worst_revenue"),
        ("names", of["distinct_trucks"], "truck_name", "NULL", "NULL"),
        ("cumulative", _selected(of["cumulative_revenue"]), "truck_name", "date", "cumulative_total_pounds"),
        ("payments", _selected(of["payment_distribution"]), "truck_name", "payment_method", '"count"'),
        ("hours", _selected(of["avg_amount_by_hour"]), "truck_name", "hour_of_day", "average_transaction_amount"),
    )
    return " UNION ALL ".join(
        f"""SELECT '{widget}' AS widget, {label} AS label, CAST({detail} AS VARCHAR) AS detail,
        CAST({value} AS DOUBLE) AS value FROM ({sql})"""
        for widget, sql, label, detail, value in parts
    )


def build() -> dict[str, str]:
    of_events, of_suppliers = _metrics(_EVENTS), _metrics(_SUPPLIERS)
    raw_lines, raw_events = _with(_RAW_LINES), _with(_RAW_EVENTS)
    history = f"""SELECT *, {_PARTS} FROM clean WHERE "at" <= {_MARK}"""
    return {
        "scan_payment_dim": _with(_EVENTS) + "SELECT * FROM payment",
        "scan_truck_dim": _with(_EVENTS) + "SELECT * FROM truck",
        "scan_history": _fact("*", f'"at" <= {_MARK}'),
        "scan_increment": _fact("*", f'"at" > {_MARK}'),
        "hwm_read": _fact('max("at") AS mark', f'"at" <= {_MARK}'),
        "hwm_update": _fact('max("at") AS mark'),
        "csv_roundtrip": _fact("*"),
        "csv_quarantine": _fact(
            """transaction_id, CASE WHEN payment_method_id NOT IN (2, 4) THEN total END AS total,
            CASE payment_method_id WHEN 2 THEN 'total is no bigint'
              WHEN 4 THEN 'at is no timestamp_ntz' END AS reason"""
        ),
        "catalog_scan": _EVENTS_LAKE,
        "catalog_partitions": _fact(
            """DISTINCT 'year=' || year("at") || '/month=' || month("at") || '/day='
            || day("at") AS "partition" """
        ),
        "sink_partitioned_overwrite": _EVENTS_LAKE,
        "sink_partitioned_append": _EVENTS_LAKE,
        "sink_compacted": _EVENTS_LAKE,
        "sink_dimension_overwrite": _with(_EVENTS) + "SELECT * FROM truck",
        "clean_drop_nulls": raw_lines
        + """SELECT * FROM fact WHERE transaction_id IS NOT NULL AND truck_id IS NOT NULL
          AND payment_method_id IS NOT NULL AND total IS NOT NULL AND "at" IS NOT NULL""",
        "clean_dedupe": raw_lines + "SELECT DISTINCT * FROM fact",
        "clean_validity": raw_lines + "SELECT * FROM valid",
        "clean_transactions": raw_lines + "SELECT * FROM clean",
        "derive_timestamp": _fact('transaction_id, "at"'),
        "derive_partitions": _fact(f'transaction_id, "at", {_PARTS}'),
        "derive_pounds": _fact("transaction_id, total / 100 AS total_pounds"),
        "derive_date": _fact('transaction_id, CAST("at" AS DATE) AS date'),
        "derive_hour": _fact('transaction_id, CAST(hour("at") AS INTEGER) AS hour_of_day'),
        "price_segment": _fact(f"transaction_id, total, {_SEGMENT} AS price_segment"),
        "filter_previous_day": _fact("*", _ON_DAY),
        "filter_selected_trucks": _selected(of_events["cumulative_revenue"]),
        "selected_payment_distribution": _selected(of_events["payment_distribution"]),
        "selected_avg_amount_by_hour": _selected(of_events["avg_amount_by_hour"]),
        "star_join_previous_day": of_events["star_join"] + f" WHERE {_ON_DAY}",
        "increment_stats": _fact(
            'count(*) AS row_count, max("at") AS latest', f'"at" > {_MARK}'
        ),
        **of_events,
        "supplier_revenue": of_suppliers["revenue_by_truck"],
        "supplier_daily_revenue": of_suppliers["daily_revenue"],
        "supplier_cumulative_revenue": of_suppliers["cumulative_revenue"],
        "supplier_payment_distribution": of_suppliers["payment_distribution"],
        "supplier_performance": of_suppliers["truck_performance"],
        "supplier_underperforming": of_suppliers["underperforming_trucks"],
        "supplier_price_segmentation": of_suppliers["price_segmentation"].replace(
            "round(l_extendedprice * 100)", "floor(l_extendedprice / 100)"
        ),
        "supplier_kpi_metrics": of_suppliers["kpi_metrics"],
        "supplier_star_join": of_suppliers["star_join"],
        "format_timestamp": _fact(
            """transaction_id, strftime("at", '%Y-%m-%d %H:%M:%S') AS at_text,
            strftime("at", '%Y-%m-%d') AS day_text"""
        ),
        "format_money": _fact(
            """transaction_id, format('£{:,.2f}', total / 100) AS money_text,
            format('{:.1f}%', total / 100) AS percent_text,
            format('{:.2f}%', total / 100 / 3) AS fine_percent_text,
            format('£{:.2f}/hour', total / 100 / 7) AS rate_text"""
        ),
        "initial_load": raw_events + history,
        "incremental_load": raw_events
        + f"""{history} UNION ALL SELECT *, {_PARTS} FROM fact WHERE "at" > {_MARK}""",
        "incremental_load_cleaned": raw_events
        + f"""{history} UNION ALL SELECT *, {_PARTS} FROM clean WHERE "at" > {_MARK}""",
        "incremental_load_late": _EVENTS_LAKE,
        "dashboard_view": _dashboard(of_events),
        "dashboard_from_summary": _dashboard(of_events),
        "daily_report": _REPORT,
        "daily_report_from_lake": _REPORT,
        "stream_incremental_load": _EVENTS_LAKE + ' WHERE "at" IS NOT NULL',
    }
