"""Every registered query gives the same rows as its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql
from check import compare, connect
from queries.registry import QUERIES


@pytest.fixture(scope="module")
def sql(sf_dir_module):
    return connect(sf_dir_module)


@pytest.fixture(scope="module")
def sf_dir_module():
    return "/root/testdata/sf0.001"


def test_each_query_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, sf_dir_module, name):
    assert compare(spark, sql, name, sf_dir_module) is None


@pytest.mark.parametrize(
    "name",
    ["filter_selected_trucks", "selected_payment_distribution", "selected_avg_amount_by_hour",
     "revenue_for_truck", "dashboard_view"],
)
def test_selections_name_trucks_that_exist(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert found and all(r["total_pounds"] > 0 for r in found if "total_pounds" in r)


def test_entry_gives_the_report(spark):
    report = entry(spark)
    assert report.columns == [
        "section_no", "section", "sort_key", "label", "value", "pct", "display", "report_date",
    ]
    assert report.first()["label"] == "total revenue"
