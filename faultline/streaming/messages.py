"""JSON messages: encoding readings, and parsing them back in batch or as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.coercion import nan_to_null, to_time
from faultline.columns import COLUMNS, Columns
from faultline.schemas import MESSAGE, TIME_FORMAT

CORRUPT = "_corrupt_record"


def encode_messages(
    df: DataFrame,
    laps: int = 1,
    lap_seconds: int = 0,
    cols: Columns = COLUMNS,
    later_seconds: int = 0,
) -> DataFrame:
    """One JSON text per reading, in `value`; times are written to the second, `later_seconds` later.

    With several laps every reading is sent once per lap, each lap `lap_seconds` after the one
    before, so that a replay adds new windows instead of counting the old ones again.
    """
    time = F.col(cols.time) + F.make_dt_interval(secs=F.lit(later_seconds))
    if laps > 1:
        df = df.withColumn("_lap", F.explode(F.sequence(F.lit(0), F.lit(laps - 1))))
        time = time + F.make_dt_interval(secs=F.col("_lap") * F.lit(lap_seconds))
    message = F.struct(
        F.date_format(time, TIME_FORMAT).alias("timestamp"),
        F.col(cols.flag).alias("secousse"),
        F.col(cols.value).alias("magnitude"),
        F.col(cols.stress).alias("tension_entre_plaque"),
    )
    return df.select(F.to_json(message).alias("value"))


def write_messages(
    messages: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    mode: str = "append",
) -> None:
    """Write messages from all tasks at once: `kafka` with a `topic`, or `text` with a `path`."""
    messages.write.format(fmt).options(**(options or {})).mode(mode).save()


def lap_folder(path: str, lap: int) -> str:
    return f"{path.rstrip('/')}/lap={lap}"


def replay_paced(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    laps: int = 1,
    lap_seconds: int = 0,
    files_per_trigger: int = 1,
    every: str | None = None,
    cols: Columns = COLUMNS,
) -> None:
    """Send stored readings (Parquet) as a stream, some files per trigger, `every` so often.

    A lap is one stream over all files, each lap `lap_seconds` after the one before. Every lap has a
    checkpoint of its own: a replay that was stopped goes on in the lap and at the file where it was.
    Where `options` has a `path`, a lap has a folder of its own there (`lap_folder`), whose log tells
    which files count.
    """
    for lap in range(laps):
        to = dict(options or {})
        if "path" in to:
            to["path"] = lap_folder(to["path"], lap)
        source = (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path)
        )
        sent = encode_messages(source, cols=cols, later_seconds=lap * lap_seconds)
        writer = sent.writeStream.format(fmt).options(**to)
        writer = writer.option("checkpointLocation", lap_folder(checkpoint, lap))
        if not every:
            writer.trigger(availableNow=True).start().awaitTermination()
            continue
        query = writer.trigger(processingTime=every).start()
        query.processAllAvailable()
        query.stop()


def _decoded(messages: DataFrame, schema: T.StructType) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    data = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(text.alias("value"), data.alias("data"))


def parse_messages(messages: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Messages to columns and `event_time`.

    A text that is no JSON gives a row of nulls, an unreadable field a null. NaN becomes null, so a
    gap in the data never counts as a large stress.
    """
    parsed = _decoded(messages, schema).select("data.*").drop(CORRUPT)
    doubles = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
    numbers = {name: nan_to_null(F.col(name)) for name in doubles}
    return parsed.withColumns({**numbers, "event_time": to_time(F.col("timestamp"), None)})


def reject_messages(messages: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Texts that could not be read in full, or that hold no event time."""
    event_time = to_time(F.col("data.timestamp"), None)
    unread = F.col(f"data.{CORRUPT}").isNotNull() | event_time.isNull()
    return _decoded(messages, schema).filter(unread).select("value")


def closing_message(df: DataFrame, after_seconds: int, cols: Columns = COLUMNS) -> DataFrame:
    """A message without figures, `after_seconds` after the last reading.

    Sent after a finite replay, it moves the watermark past the windows of all readings, so that a
    stream in append mode emits them.
    """
    last = df.agg(F.max(cols.time).alias("last"))
    end = F.col("last") + F.make_dt_interval(secs=F.lit(after_seconds))
    message = F.struct(F.date_format(end, TIME_FORMAT).alias("timestamp"))
    return last.select(F.to_json(message).alias("value"))
