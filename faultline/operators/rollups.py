"""Statistics per time window, hour of day and entity.

Every rollup is one aggregation whose partial results are combined before the shuffle, so a hot
window or entity sends one row per task, not its readings.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.columns import COLUMNS, Columns
from faultline.schemas import TIME_FORMAT


def reading_stats(cols: Columns = COLUMNS) -> list[Column]:
    """The five statistics of every rollup of readings."""
    return [
        cols.count().alias("nombre_observations"),
        cols.flagged().alias("nombre_secousses"),
        cols.value_mean().alias("magnitude_moyenne"),
        cols.value_max().alias("magnitude_max"),
        cols.stress_mean().alias("tension_moyenne"),
    ]


def _keys(entity: str | None) -> list[str]:
    return [entity] if entity else []


def window_stats(
    df: DataFrame,
    width: str,
    slide: str | None = None,
    entity: str | None = None,
    cols: Columns = COLUMNS,
) -> DataFrame:
    """Reading statistics per `window` (and entity). Readings without a time are in no window."""
    window = F.window(cols.time, width, slide) if slide else F.window(cols.time, width)
    return df.groupBy(*_keys(entity), window).agg(*reading_stats(cols))


def hourly_stats(df: DataFrame, cols: Columns = COLUMNS) -> DataFrame:
    """Reading statistics per hour, the hour as text in `window_start`."""
    start = F.date_format("window.start", TIME_FORMAT)
    return window_stats(df, "1 hour", cols=cols).withColumn("window_start", start).drop("window")


def hour_profile(df: DataFrame, entity: str | None = None, cols: Columns = COLUMNS) -> DataFrame:
    """Reading statistics per hour of day (and entity). Readings without a time have a null hour."""
    return df.groupBy(*_keys(entity), F.hour(cols.time).alias("heure")).agg(*reading_stats(cols))


def stress_trend(df: DataFrame, width: str = "1 hour", cols: Columns = COLUMNS) -> DataFrame:
    """Mean stress per window: over all readings and over flagged readings only."""
    return df.groupBy(F.window(cols.time, width)).agg(
        cols.stress_mean().alias("tension_moyenne"),
        cols.stress_mean_flagged().alias("tension_moyenne_secousses"),
        cols.flagged().alias("nombre_secousses"),
    )


def flag_counts(df: DataFrame, entity: str, cols: Columns = COLUMNS) -> DataFrame:
    """Flagged readings per entity."""
    return df.groupBy(entity).agg(cols.flagged().alias("nombre_secousses"))


def mean_above(df: DataFrame, floor: float = 0.0, cols: Columns = COLUMNS) -> DataFrame:
    """Mean value of the readings above `floor`."""
    return df.filter(F.col(cols.value) > floor).agg(F.avg(cols.value).alias("magnitude_moyenne"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("nombre_lignes")).select(
            F.lit(name).alias("nom_table"), "nombre_lignes"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
