"""Late messages: kept beside the stream, and added to the windows it has published.

The alert stream drops a message whose windows the watermark has closed. Two streams over the same
messages make up for that:

* `published_windows` publishes the sums of each window once the watermark has passed it;
* the ledger stores the sums of each batch per pane of time, late messages included.

Sums are additive, so what the ledger has more than a published window came late. `repaired` adds it, and
derives levels and texts anew. It does not matter how the two streams cut their batches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from faultline.columns import ADDED, STREAM_COLUMNS, Columns, merged_sums, pane_sums, reading_sums
from faultline.functions.timeparts import duration_seconds
from faultline.streaming.upserts import batch_folder, read_batches, start_batches

# The latest reading of a pane and batch, which moves the watermark.
LAST = "last"


def published_windows(
    readings: DataFrame,
    watermark: str = "10 minutes",
    width: str = "5 minutes",
    slide: str = "1 minute",
    cols: Columns = STREAM_COLUMNS,
) -> DataFrame:
    """The sums of sliding windows; in append mode each is sent once, when the watermark has passed."""
    window = F.window(cols.time, width, slide)
    return readings.withWatermark(cols.time, watermark).groupBy(window).agg(*reading_sums(cols))


def _ledger_rows(readings: DataFrame, slide: str, cols: Columns) -> DataFrame:
    """One row per pane; a pane begins with a window and ends before the next one begins."""
    return pane_sums(readings, slide, cols=cols, extra=[F.max(cols.time).alias(LAST)])


def start_ledger(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    slide: str = "1 minute",
    trigger: Mapping[str, object] | None = None,
    cols: Columns = STREAM_COLUMNS,
) -> StreamingQuery:
    """Store the sums of every batch per pane. The stream keeps no state; a repeated batch overwrites its
    own rows."""

    def store(batch: DataFrame, number: int) -> None:
        _ledger_rows(batch, slide, cols).write.mode("overwrite").parquet(batch_folder(path, number))

    return start_batches(readings, store, checkpoint, "append", trigger)


def read_ledger(
    spark: SparkSession,
    path: str,
    readings: DataFrame,
    slide: str = "1 minute",
    cols: Columns = STREAM_COLUMNS,
) -> DataFrame:
    """The stored panes; `readings` names the columns they were made of."""
    schema: T.StructType = _ledger_rows(readings, slide, cols).schema
    return read_batches(spark, path, schema).select(*schema.names)


def late_sums(
    published: DataFrame,
    ledger: DataFrame,
    closed: Column,
    width: str = "5 minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """Sums of the late messages of every window that ends at or before `closed`, also of windows that
    have late messages only. Windows without any have no row."""
    if duration_seconds(width) % duration_seconds(slide):
        raise ValueError("windows must be made of whole panes")
    whole = (
        ledger.groupBy(F.window("pane", width, slide)).agg(*merged_sums()).filter(F.col("window.end") <= closed)
    )
    sent = published.select(
        F.col("window").alias("_window"),
        *(F.col(name).alias(f"_{name}") for name in [*ADDED, "stress_exact", "stress_exact_n"]),
    )
    both = whole.join(sent, F.col("window") == F.col("_window"), "left")

    def more(name: str) -> Column:
        return F.col(name) - F.coalesce(F.col(f"_{name}"), F.lit(0).cast(both.schema[name].dataType))

    exact_n = more("stress_exact_n")
    known = F.col("stress_exact").isNotNull() & (
        F.col("_stress_exact").isNotNull() | (F.coalesce(F.col("_stress_exact_n"), F.lit(0)) == 0)
    )
    return both.filter(more("n") > 0).select(
        "window",
        *(more(name).alias(name) for name in ADDED),
        # The extremes of the whole window: those of the published part do not change them.
        "value_max",
        "stress_max",
        "stress_min",
        F.when(known & (exact_n > 0), more("stress_exact")).alias("stress_exact"),
        F.when(known, exact_n).otherwise(0).alias("stress_exact_n"),
    )


def repaired(published: DataFrame, late: DataFrame) -> DataFrame:
    """The windows with their late messages added, one row each, for `risk.alerts_of_sums`."""
    names = late.columns
    together = published.select(*names).unionByName(late)
    return together.groupBy("window").agg(*merged_sums()).select(*names)


def closed_until(ledger: DataFrame, watermark: str = "10 minutes") -> Column:
    """Where the watermark stands once all messages of the ledger are read."""
    behind = F.make_dt_interval(secs=F.lit(duration_seconds(watermark)))
    return ledger.select(F.max(LAST) - behind).scalar()
