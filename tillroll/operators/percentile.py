"""Exact percentile without gathering all values in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sources.shared import stage


def exact_percentile(df: DataFrame, value: str, fraction: float) -> DataFrame:
    """One row, `percentile`: the linearly interpolated percentile of a column.

    Distinct values and their counts are dealt out by range and staged. One count per range
    comes to the driver and tells which one or two ranges hold the wanted ranks; only those
    are put in order. It is the same way at every size. Null values are ignored; no values
    give null.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    values = df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"))
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranges = stage(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    sizes = ranges.groupBy("part").agg(F.sum("n").alias("n")).collect()

    below, held = 0, {}
    rank = (sum(size["n"] for size in sizes) - 1) * fraction
    for part, n in sorted(map(tuple, sizes)):
        if below + n > math.floor(rank) and below <= math.ceil(rank):
            held[part] = below
        below += n
    start = F.lit(0)
    for part, before in held.items():
        start = F.when(F.col("part") == part, F.lit(before)).otherwise(start)
    upwards = Window.partitionBy("part").orderBy("v")
    reached = ranges.where(F.col("part").isin(*held)).select(
        "v", (start + F.sum("n").over(upwards)).alias("reached")
    )
    part_way = rank - math.floor(rank)
    return reached.agg(
        F.min(F.when(F.col("reached") > math.floor(rank), F.col("v"))).alias("below"),
        F.min(F.when(F.col("reached") > math.ceil(rank), F.col("v"))).alias("above"),
    ).select((F.col("below") + (F.col("above") - F.col("below")) * part_way).alias("percentile"))
