"""Batch and streaming scans."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultline.sources.sinks import DAY


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """CSV files with a header line. The schema is given, so no pass over the data infers it.

    A file whose header names other columns, or the same in another order, is an error.
    """
    return spark.read.schema(schema).options(header=True, enforceSchema=False).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_days(
    spark: SparkSession,
    path: str,
    first: date | None = None,
    last: date | None = None,
    look_back_seconds: int = 0,
    time: str = "date",
    day: str = DAY,
) -> DataFrame:
    """Rows published by day, from the `first` to the `last` day, both included; rows of the
    `look_back_seconds` before come along, for frames that reach back.

    Only the folders of these days are listed and read.
    """
    rows = spark.read.parquet(path)
    if first:
        start = datetime.combine(first, datetime.min.time()) - timedelta(seconds=look_back_seconds)
        rows = rows.filter((F.col(day) >= start.date()) & (F.col(time) >= F.lit(start)))
    if last:
        rows = rows.filter(F.col(day) <= last)
    return rows.drop(day)


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """An unbounded table.

    Message sources deliver the text or bytes in `value`: `kafka` with `kafka.bootstrap.servers`
    and `subscribe` (the connector must be on the class path), or `text` with `path`. Pace is set
    by `maxOffsetsPerTrigger` or `maxFilesPerTrigger`.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load()
