"""Results published by day, and computed again for some days only.

A rerun reads the folders of its days and one frame before them, and replaces its days alone. Its rows are
those of a run over everything: windows of an hour or less lie within a day, and trailing frames find
all their readings.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.columns import COLUMNS, Columns
from faultline.operators.precursors import precursor_features
from faultline.operators.rollups import hourly_stats, window_stats
from faultline.sources.readers import read_days
from faultline.sources.sinks import write_days


def _hourly(readings: DataFrame, frame_seconds: int, entity: str | None, cols: Columns) -> DataFrame:
    return hourly_stats(readings, cols).withColumn("debut", F.col("window_start").cast("timestamp_ntz"))


def _quarter_hours(
    readings: DataFrame, frame_seconds: int, entity: str | None, cols: Columns
) -> DataFrame:
    stats = window_stats(readings, "15 minutes", entity=entity, cols=cols)
    return stats.withColumn("debut", F.col("window.start"))


def _frames(readings: DataFrame, frame_seconds: int, entity: str | None, cols: Columns) -> DataFrame:
    found = precursor_features(readings, frame_seconds, entity, previous=False, cols=cols)
    return found.withColumn("debut", F.col(cols.time))


# What can be published by day, and whether its rows look back over one frame.
TABLES: dict[str, tuple[Callable[..., DataFrame], bool]] = {
    "horaire": (_hourly, False),
    "quarts_heure": (_quarter_hours, False),
    "precurseurs": (_frames, True),
}


def publish_days(
    spark: SparkSession,
    source: str,
    target: str,
    table: str,
    first: date | None = None,
    last: date | None = None,
    frame_seconds: int = 3600,
    entity: str | None = None,
    cols: Columns = COLUMNS,
) -> None:
    """Compute a table from readings published by day, for all days or from `first` to `last`.

    Days without readings stay as they were published. Readings without a time are in no window, and
    their frames are published by runs over all days only.
    """
    build, looks_back = TABLES[table]
    readings = read_days(spark, source, first, last, frame_seconds * looks_back, cols.time)
    rows = build(readings, frame_seconds, entity, cols)
    if first:
        rows = rows.filter(F.to_date("debut") >= F.lit(first))
    write_days(rows, target, "debut")
