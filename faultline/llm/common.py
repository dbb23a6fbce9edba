"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import scratch_dir

# Runs of these characters separate words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"

# Rows of one key are numbered in this many hash buckets, so that no task sorts a whole hot key.
RANK_BUCKETS = 4096

# Python code takes texts in portions of at most this many characters (or one text).
PORTION_CHARS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet into the shared folder and read it back: cuts lineage, survives
    lost executors, and lets later steps read only the columns they need."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: every fifth, by a checksum of the identifier."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def words(text: Column) -> Column:
    """The words of a text, in order; null counts as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({NOT_BLANKS})"), F.lit(1))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in column `name`.

    Rows are spread over hash buckets of the `order` columns, counted per bucket, and numbered inside
    their bucket after the rows of the buckets before it. The order is that of (bucket, `order`), so
    it depends on the rows alone; of rows that are equal in `order` any may come first.
    """
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(RANK_BUCKETS)))
    counts = spread.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        spread.join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_start") + F.row_number().over(within) - 1)
        .drop("_bucket", "_start")
    )


def release_memory() -> None:
    """Give freed memory back to the system. A Python worker outlives its task, and allocators would
    keep what the largest portion took while the next stages run beside it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def portions(
    frames: Iterable[pd.DataFrame], column: str, most: int = PORTION_CHARS
) -> Iterator[pd.DataFrame]:
    """Cut batches so that the texts of one portion stay within `most` characters."""
    for frame in frames:
        sizes = frame[column].str.len().fillna(0).to_numpy()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield frame.iloc[start:i]
                start, total = i, 0
            total += size
        if start < len(frame):
            yield frame.iloc[start:]
    release_memory()


def arrow_portions(
    batches: Iterable[pa.RecordBatch], column: str, most: int = PORTION_CHARS
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one portion stay within `most` bytes (or are one)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def by_portion(
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    column: str = "text",
    most: int = PORTION_CHARS,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that applies `work` to one portion of texts at a time. What a portion
    took is free before the next one comes, and goes back to the system after the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in arrow_portions(batches, column, most):
            yield work(portion)
            del portion
        release_memory()

    return run


def coded_words(texts: Sequence[str] | pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of texts inside Python code, the same as `words` has: the distinct ones, the number
    of each word in order, and where each text starts and ends in that order."""
    if isinstance(texts, pa.Array):
        # Rows are taken rather than sliced: string kernels misread the offsets of slices.
        texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    else:
        texts = pa.array(texts, pa.large_string())
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    numbers = coded.indices.to_numpy()
    distinct = coded.dictionary.to_pylist()
    # Blanks at an end of a text leave an empty part there.
    if "" in distinct:
        real = numbers != distinct.index("")
        ends = np.concatenate(([0], np.cumsum(real)))[ends]
        numbers = numbers[real]
    return distinct, numbers, ends


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gather(offsets: np.ndarray, flat: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenate the slices `flat[offsets[c]:offsets[c + 1]]` for all codes."""
    starts = offsets[codes]
    sizes = offsets[codes + 1] - starts
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    shift = np.repeat(starts - (ends - sizes), sizes)
    return flat[shift + np.arange(ends[-1])]


def offsets_of(sizes: Iterable[int]) -> np.ndarray:
    if not isinstance(sizes, np.ndarray):
        sizes = np.fromiter(sizes, np.int64)
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def keep_rows(docs: DataFrame, kept: DataFrame, content: Column, digest: str) -> DataFrame:
    """One row of `docs` for each pair of `doc_id` and content digest in `kept`; all columns stay as they
    are, whatever their names."""
    marked = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("id"), content.alias("content")
    )
    wanted = kept.select(F.col("doc_id").alias("id"), F.col(digest).alias("content"))
    same = marked["id"].eqNullSafe(wanted["id"]) & (marked["content"] == wanted["content"])
    found = marked.join(wanted, same, "left_semi")
    return found.dropDuplicates(["id", "content"]).select("row.*")


def new_prefix(df: DataFrame, prefix: str) -> str:
    """`prefix`, with more underscores if a column of `df` already begins with it."""
    while any(name.lower().startswith(prefix.lower()) for name in df.columns):
        prefix = f"_{prefix}"
    return prefix
