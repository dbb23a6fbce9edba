"""Totals along an order of all rows, without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import stage_table


def total_before(df: DataFrame, order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add `name`: the sum of `weight` over all rows that come before a row in `order`.

    Rows are cut into ranges of the order and stored, so that a lost task cannot cut them anew. The
    driver sees one sum per range, however many rows there are; inside a range a window adds up. Rows
    that are equal in `order` lie in one range, in any order, so give an order without hot ties.
    """
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    placed = stage_table(ranges, "ranges")
    sums = placed.groupBy("_range").agg(F.sum(weight).alias("_total")).orderBy("_range").collect()
    starts = [0, *accumulate(row["_total"] or 0 for row in sums)]
    known = [(row["_range"], start) for row, start in zip(sums, starts, strict=False)]
    offsets = df.sparkSession.createDataFrame(known, "_range int, _start long")
    before = (
        Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(weight).over(before), F.lit(0)))
        .drop("_range", "_start")
    )
