"""Plans keep their shape: pruned scans, sums before joins, broadcasts within bounds."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from queries.registry import QUERIES
from tillroll.adapters import events_star, supplier_star
from tillroll.operators import metrics
from tillroll.operators.filters import between_days, on_day
from tillroll.operators.star import dimension_bytes, roll_up, star_join
from tillroll.plans import report
from tillroll.sources import read_transactions, write_transactions


METHODS = ("click", "error", "purchase", "signup", "view")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def landed(spark, sf_dir, lake):
    write_transactions(events_star(spark, sf_dir).fact, lake, "overwrite")
    return read_transactions(spark, lake)


def test_day_filters_prune_folders_and_row_groups(landed):
    one = on_day(landed, date(2024, 1, 15))
    several = between_days(landed, date(2024, 1, 15), date(2024, 1, 17))
    for df, days in ((one, 1), (several, 3)):
        plan = executed(df)
        assert "PartitionFilters: []" not in plan
        assert "GreaterThanOrEqual(at," in plan
        assert df.select("day").distinct().count() == days
    scan = [n for n in _nodes(one) if "FileSourceScan" in n.getClass().getName()][0]
    assert len(one.inputFiles()) and scan.selectedPartitions().partitionCount() == 1


def _nodes(df):
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_cutoffs_reach_the_scan(spark, sf_dir):
    assert "LessThanOrEqual(at," in executed(QUERIES["scan_history"](spark, sf_dir))
    assert "GreaterThan(at," in executed(QUERIES["scan_increment"](spark, sf_dir))


def test_roll_up_reads_only_its_columns_and_sums_before_joining(spark, sf_dir):
    plan = executed(metrics.revenue_by_truck(roll_up(supplier_star(spark, sf_dir))))
    fact_scan = next(line for line in plan.splitlines() if "l_extendedprice" in line and "FileScan" in line)
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string>" in fact_scan
    lines = plan.splitlines()
    depth = {
        kind: min(len(line) - len(line.lstrip(" :+-")) for line in lines if kind in line)
        for kind in ("Join", "partial_sum(total")
    }
    assert depth["partial_sum(total"] > depth["Join"]


def test_join_broadcasts_only_measured_dimensions(spark, sf_dir):
    star = events_star(spark, sf_dir)
    within = star_join(star)
    beyond = star_join(star, broadcast_bytes=0)
    assert dimension_bytes(star.payment)[0] == sum(8 + len(m) for m in METHODS)
    hinted = lambda df: df._jdf.queryExecution().logical().toString().count("ResolvedHint")
    assert (hinted(within), hinted(beyond)) == (2, 0)
    assert "SortMergeJoin" not in executed(within)
    assert sorted(rows(within)) == sorted(rows(beyond))


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def shuffled(spark):
    """Without broadcasts by Spark's own limits, as when sums are ready before the methods are."""
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    for key, value in SHUFFLED.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name",
    [
        "supplier_daily_revenue",
        "supplier_cumulative_revenue",
        "supplier_payment_distribution",
        "supplier_kpi_metrics",
        "daily_revenue",
        "avg_amount_by_hour",
    ],
)
def test_sums_are_not_shuffled_by_the_few_payment_methods(spark, sf_dir, shuffled, name):
    plan = executed(QUERIES[name](spark, sf_dir))
    assert "hashpartitioning(truck_id" in plan  # what is not measured is shuffled here
    assert "hashpartitioning(payment_method_id" not in plan


def test_roll_up_broadcasts_only_methods_measured_small(spark, fleet, shuffled):
    noon = "2024-01-15 12:00:00"
    sales = [(i, truck, method, i, noon) for i, (truck, method) in enumerate(
        [(1, 1), (1, 2), (2, 1), (2, 1), (3, 2), (4, 1), (1, 9), (9, 1), (1, None), (None, 1)]
    )]
    star = fleet(*sales)
    twice = type(star)(star.fact, star.payment.union(star.payment.where("payment_method_id = 2")), star.truck)
    for each in (star, twice):
        within = roll_up(each, "date")
        beyond = roll_up(each, "date", broadcast_bytes=0)
        assert "hashpartitioning(payment_method_id" not in executed(within)
        assert "hashpartitioning(payment_method_id" in executed(beyond)
        assert sorted(map(str, rows(within))) == sorted(map(str, rows(beyond)))
    assert sum(row["sales"] for row in roll_up(star).collect()) == 6
    assert sum(row["sales"] for row in roll_up(twice).collect()) == 8


def test_join_beyond_the_bound_splits_a_hot_truck(spark, fleet):
    """A truck with most of the sales, both sides shuffled."""
    sales = [(i, 1 if i % 10 else 2, 1, 100, "2024-01-15 12:00:00") for i in range(20_000)]
    star = fleet(*sales)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        spread = type(star)(star.fact.repartition(16), star.payment, star.truck)
        joined = star_join(spread, broadcast_bytes=0)
        assert joined.agg(F.count("transaction_id"), F.sum("total")).first() == (20_000, 2_000_000)
        joined.collect()
        assert "skew=true" in executed(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_day_is_written_by_several_tasks(spark, facts, lake):
    rows_of_a_day = [(i, 1, 1, i, f"2024-01-15 12:{i % 60:02d}:00") for i in range(20_000)]
    other = [(i, 1, 1, i, "2024-01-16 12:00:00") for i in range(100)]
    fact = facts(*rows_of_a_day, *other).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "32k")
        write_transactions(fact, lake, "overwrite")
    finally:
        spark.conf.set(key, before)
    files = read_transactions(spark, lake).where("day = 15").inputFiles()
    assert len([f for f in files if "day=15" in f]) > 1
    assert read_transactions(spark, lake).count() == 20_100


WRITING = ("sink", "catalog", "hwm", "csv", "initial", "incremental", "stream", "daily_report_from")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITING)))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = executed(QUERIES[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_operators_do_not_cache(spark, sf_dir):
    for name in ("daily_report", "underperforming_trucks", "kpi_metrics"):
        assert "InMemoryTableScan" not in executed(QUERIES[name](spark, sf_dir))


def test_cumulative_ends_at_total(spark, sf_dir):
    sales = roll_up(events_star(spark, sf_dir), "date")
    last = metrics.cumulative_revenue(sales).groupBy("truck_name").agg(
        F.max_by("cumulative_total_pounds", "date").alias("total_pounds")
    )
    assert sorted(rows(last)) == sorted(rows(metrics.revenue_by_truck(sales)))


def test_the_report_is_one_aggregation_of_the_day(spark, sf_dir, monkeypatch):
    staged = []
    real = report.stage
    monkeypatch.setattr(report, "stage", lambda df: staged.append(executed(df)) or real(df))
    daily_lines = report.daily_report(events_star(spark, sf_dir), date(2024, 1, 16))
    assert daily_lines.count() > 5
    assert len(staged) == 1 and staged[0].count("Expand") == 1
