"""Text to typed values. A value that cannot be read becomes null, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.schemas import TIME_FORMAT


def to_flag(column: Column) -> Column:
    """Boolean from any spelling Spark knows (`True`, `true`, `1`, `no`, ...)."""
    return column.cast("string").try_cast("boolean")


def to_number(column: Column) -> Column:
    return column.try_cast("double")


def to_time(column: Column, pattern: str | None = TIME_FORMAT) -> Column:
    if pattern is None:
        return F.try_to_timestamp(column)
    return F.try_to_timestamp(column, F.lit(pattern))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)
