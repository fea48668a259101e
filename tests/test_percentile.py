"""The distributed percentile against numpy, at every size."""

import random

import numpy
import pytest
from pyspark.sql import functions as F

from tillroll.operators.percentile import exact_percentile


def percentile(spark, values, fraction):
    df = spark.createDataFrame([(v,) for v in values], "pence long").repartition(5)
    return exact_percentile(df, "pence", fraction).first()["percentile"]


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("size", [1, 2, 6, 101])
def test_small(spark, size, fraction):
    draw = random.Random(size)
    values = [draw.randrange(-50, 50) for _ in range(size)]
    assert percentile(spark, values, fraction) == pytest.approx(
        float(numpy.percentile(values, fraction * 100))
    )


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.333, 1.0])
@pytest.mark.parametrize("kind", ["spread", "third equal", "few values"])
def test_large(spark, kind, fraction):
    draw = random.Random(7)
    values = [draw.randrange(10**9) for _ in range(60_000)]
    if kind == "third equal":
        values[:20_000] = [10**8] * 20_000
    if kind == "few values":
        values = [v % 3 for v in values]
    assert percentile(spark, values, fraction) == pytest.approx(
        float(numpy.percentile(values, fraction * 100)), rel=1e-12
    )


@pytest.mark.parametrize("size", [10**5, 10**6])
def test_many_values_and_no_window_over_everything(spark, size):
    df = spark.range(size).select((F.col("id") * 7919 % size).alias("pence"))
    found = exact_percentile(df, "pence", 0.25)
    assert found.first()["percentile"] == pytest.approx((size - 1) * 0.25)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(part" in plan


def test_nulls_are_ignored_and_nothing_is_null(spark):
    assert percentile(spark, [None, 4, None, 2], 0.5) == 3.0
    assert percentile(spark, [None], 0.5) is None


def test_known_six_trucks(spark):
    """Interpolation between ranks, as in a published day's six revenues."""
    values = [11063, 29664, 50000, 100000, 152000, 253684]
    assert percentile(spark, values, 0.25) == pytest.approx(34748)
