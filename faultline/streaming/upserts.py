"""A sink of rows that change: each batch of a stream stores the rows it sets, the last one counts.

A batch writes the folder of its own number and nothing else. If it runs again after a failure it writes
the same rows to the same folder, so a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from faultline.session import folder_names, remove, rename

BATCH = "batch"
# Begins the names of folders that readers do not see.
FOLDED = "_folded-"


def batch_folder(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/{BATCH}={batch}"


def start_batches(
    df: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "update",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start a stream whose batches are given to `store` with their numbers."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(store).start()


def start_upserts(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Store every batch of `df`: in update mode the rows that changed, in complete mode all."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, number))

    return start_batches(df, store, checkpoint, mode, trigger)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored rows, with the number of their batch."""
    numbered = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(numbered).parquet(path)


def read_upserts(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """One row for each key: that of its last batch."""
    return _latest(read_batches(spark, path, schema), schema, keys)


def _latest(rows: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    rest = [name for name in schema.names if name not in keys]
    last = F.max_by(F.struct(*rest), BATCH).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*schema.names)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Fold all batches but the last into one folder, that of the last but one.

    The last batch is left alone, as it may run again. The folder that takes the place is complete by
    itself, so older folders beside it change no result. If a compaction fails just before it is put in
    place, its rows are missing until the next one, which begins with that.
    """
    path = path.rstrip("/")
    names = folder_names(spark, path)
    for name in (name for name in names if name.startswith(FOLDED)):
        target = f"{BATCH}={name.removeprefix(FOLDED)}"
        if target in names or "_SUCCESS" not in folder_names(spark, f"{path}/{name}"):
            remove(spark, f"{path}/{name}")
        else:
            rename(spark, f"{path}/{name}", f"{path}/{target}")
    batches = sorted(
        int(name.removeprefix(f"{BATCH}="))
        for name in folder_names(spark, path)
        if name.startswith(f"{BATCH}=")
    )
    if len(batches) < 3:
        return
    *older, target, _ = batches
    numbered = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    folders = [batch_folder(path, number) for number in (*older, target)]
    rows = spark.read.schema(numbered).option("basePath", path).parquet(*folders)
    folded = f"{path}/{FOLDED}{target}"
    _latest(rows, schema, keys).write.parquet(folded)
    remove(spark, batch_folder(path, target))
    rename(spark, folded, batch_folder(path, target))
    for number in older:
        remove(spark, batch_folder(path, number))
