"""Session settings, the shared scratch folder, and steps that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A keyed side is broadcast only when it was measured: at most this many rows and bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32_000_000

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "faultline", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators expect; `conf` uses `__` for the dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # State of streams on disk, and of each batch only its changes in the checkpoint.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of the cluster (`spark.checkpoint.dir`).

    Only a local session without a checkpoint folder falls back to a temporary one of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="faultline-")
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    return path


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tasks started inside the block give Python at most so many rows at a time. Each task holds a batch
    in the JVM and again in its worker, beside the one before, so long texts need few rows. What is not
    computed at the end of the block is computed with the settings from before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# The folders handed out inside each open `scratch` block.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what was stored in the shared folder inside the block, at its end: intermediate results,
    not what was written to other paths. Results must be written or collected before."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove(spark, path)


def _hadoop(spark: SparkSession, path: str):
    """A path, and the file system it is on."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing happens if there is none."""
    found, files = _hadoop(spark, path)
    files.delete(found, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    found, files = _hadoop(spark, path)
    if not files.rename(found, _hadoop(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it does not exist."""
    found, files = _hadoop(spark, path)
    if not files.exists(found):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(found))


def stage(df: DataFrame) -> DataFrame:
    """Compute `df` once and keep it in reliable storage, so lost executors cost no recomputation.

    Spark deletes checkpoints that nothing refers to any more if the session says so
    (`spark.cleaner.referenceTracking.cleanCheckpoints`).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, purpose: str) -> DataFrame:
    """Like `stage`, as Parquet: for wide results read several times with different columns."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _wide(df: DataFrame) -> Column:
    """Bytes of a row: texts and arrays by their length, other columns by eight."""
    parts = [F.lit(8 * len(df.columns))]
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif kind.startswith("array"):
            parts.append(8 * F.coalesce(F.size(name), F.lit(0)))
    return sum(parts[1:], parts[0])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether `df`, which should be stored, is small enough to be sent to every executor."""
    rows = df.limit(MAX_BROADCAST_ROWS + 1)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(_wide(df)), F.lit(0))).first()
    return n <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


def estimated_bytes(df: DataFrame) -> int | None:
    """What the optimizer expects `df` to hold; none where it knows no size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 2**60 else None


def attach(
    df: DataFrame, small: DataFrame, entity: str | Sequence[str] | None = None
) -> DataFrame:
    """Add the columns of `small` to every row of `df`: one row overall, or one row per entity.

    The one-row form is a scalar subquery; a comparison with a single column reaches the scan as a
    literal. The keyed form (one key or several) is broadcast only after it was measured; beyond the
    limits it is an ordinary join, where adaptive execution splits skewed partitions. Rows of a key
    that `small` lacks stay, with nulls.
    """
    if entity is None and len(small.columns) == 1:
        return df.withColumn(small.columns[0], small.scalar())
    if entity is None:
        row = small.select(F.struct(*small.columns).alias("_row")).scalar()
        return df.withColumn("_row", row).select(*df.columns, "_row.*")
    if fits_broadcast(small):
        small = F.broadcast(small)
    return df.join(small, entity if isinstance(entity, str) else list(entity), "left")
