"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column that holds the day in published tables, and how many tasks may write one day.
DAY = "jour"
DAY_TASKS = 16


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_days(df: DataFrame, path: str, time: str, day: str = DAY) -> None:
    """Publish rows in one folder per day of `time`; days that `df` has replace those published before,
    other days stay. Rows without a time share a folder of their own."""
    dated = df.withColumn(day, F.to_date(time))
    # A day's rows lie together, so that every task writes few days.
    placed = dated.repartition(day, F.pmod(F.xxhash64(time), F.lit(DAY_TASKS)))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)


def save_tables(tables: Mapping[str, DataFrame], base: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every table as Parquet to a folder of its own name; returns the folders."""
    paths = {name: f"{base.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_parquet(df, paths[name], mode)
    return paths
