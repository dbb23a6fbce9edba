"""Risk alerts from an unbounded table of messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultline.operators.risk import RULES, RiskRules, risk_alerts
from faultline.columns import STREAM_COLUMNS, Columns
from faultline.functions.timeparts import flatten_window
from faultline.schemas import TIME_FORMAT
from faultline.streaming.upserts import batch_folder, start_batches


def risk_stream(
    readings: DataFrame,
    watermark: str = "10 minutes",
    width: str = "5 minutes",
    slide: str = "1 minute",
    rules: RiskRules = RULES,
    cols: Columns = STREAM_COLUMNS,
) -> DataFrame:
    """Alerts per sliding window of parsed messages.

    State is one row per open window. In append and update mode the watermark drops later readings
    and frees closed windows; complete mode keeps every window for good.
    """
    return risk_alerts(readings.withWatermark(cols.time, watermark), width, slide, rules, cols)


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON texts in `value`, the form in which message sinks take them."""
    flat = flatten_window(alerts)
    times = {c: F.date_format(c, TIME_FORMAT) for c in ("window_start", "window_end")}
    return flat.withColumns(times).select(F.to_json(F.struct(*flat.columns)).alias("value"))


def start_feed(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    mode: str = "update",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Feed two outputs from one stream: the table of alerts under `path` (`read_upserts` reads it), and a
    JSON text per alert of the batch for `fmt`.

    The messages are read back from the stored batch, so the windows are computed once. A repeated
    batch overwrites its own rows and, where `options` has a `path`, its own messages; a message broker
    then gets them twice.
    """

    def store(batch: DataFrame, number: int) -> None:
        folder = batch_folder(path, number)
        batch.write.mode("overwrite").parquet(folder)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        to = dict(options or {})
        if "path" in to:
            to["path"] = batch_folder(to["path"], number)
        writer = encode_alerts(stored).write.format(fmt).options(**to)
        writer.mode("overwrite" if "path" in to else "append").save()

    return start_batches(alerts, store, checkpoint, mode, trigger)


def start(
    df: DataFrame,
    fmt: str,
    checkpoint: str | None = None,
    mode: str = "append",
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start writing a stream; `awaitTermination()` on the result runs it until it is stopped.

    `checkpoint` belongs on storage all executors reach; sinks that keep results need it. `trigger`
    is, for example, `{"processingTime": "10 seconds"}` or `{"availableNow": True}`.
    """
    writer = df.writeStream.format(fmt).outputMode(mode).options(**(options or {}))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()
