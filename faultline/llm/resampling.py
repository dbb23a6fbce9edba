"""Importance resampling towards a target: documents are drawn that look like the target's texts.

1. Texts are cut into words; features are runs of words, hashed into buckets by CRC-32. The distinct
   features of a portion are grouped by their length in bytes into two-dimensional arrays, all checksums
   of a group advance column by column, and the buckets are scattered back to the features' places.
2. Bucket counts of the corpus and of the target give every bucket a gain: how much likelier it is in
   the target. The arrays have as many numbers as there are buckets, whatever the corpus holds.
3. The weight of a document is the sum of its gains; a draw that depends on its identifier alone is added
   to it (the Gumbel trick), and the documents with the largest scores are drawn without replacement.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.ordering import total_before
from faultline.llm.common import arrow_portions, coded_words, offsets_of, release_memory, staged

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10

# Every ASCII byte but letters and digits ends a word, A-Z are lower-cased, and all bytes
# of other characters belong to words.
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b >= 0x61 and (b < 0x7B or b > 0x7F) else 0x20
    for b in range(256)
)

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

# Longer features are cut into blocks of so many bytes, which are rows of one array too.
BLOCK = 256


# --- checksums ----------------------------------------------------------------------------------


@functools.cache
def _byte_table() -> np.ndarray:
    """What eight steps of the checksum make of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def _advance(state: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The checksums of all rows, one column of bytes after the other."""
    table = _byte_table()
    for column in columns:
        state = table[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


@functools.cache
def _block_tables() -> np.ndarray:
    """What a block of zeros makes of each byte of the state, by place of the byte."""
    bits = np.arange(256, dtype=np.uint32)
    zeros = np.zeros((BLOCK, 256), np.uint8)
    return np.stack([_advance(bits << np.uint32(8 * place), zeros) for place in range(4)])


def crc32_of(features: pa.Array) -> np.ndarray:
    """The CRC-32 of every text's UTF-8 bytes."""
    features = features.cast(pa.large_binary())
    offsets = np.frombuffer(features.buffers()[1], np.int64)[features.offset :][: len(features) + 1]
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    out = np.zeros(len(features), np.uint32)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        starts = offsets[rows]
        # Rows of a transposed array are columns of the group.
        head = size % BLOCK if size > BLOCK else size
        state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        state = _advance(state, data[np.arange(head)[:, None] + starts])
        if head < size:
            places = starts[:, None] + np.arange(head, size, BLOCK)
            none = np.zeros(places.size, np.uint32)
            blocks = _advance(none, data[np.arange(BLOCK)[:, None] + places.ravel()])
            tables = _block_tables()
            for block in blocks.reshape(places.shape).T:
                moved = [tables[i][state >> np.uint32(8 * i) & 0xFF] for i in range(4)]
                state = moved[0] ^ moved[1] ^ moved[2] ^ moved[3] ^ block
        out[rows] = state ^ np.uint32(0xFFFFFFFF)
    return out


# --- features -----------------------------------------------------------------------------------


def _runs(distinct: list[str], codes: np.ndarray, ends: np.ndarray, most_words: int):
    """The distinct features of a portion, the number of each in order, and where texts end.

    Features of a text are ordered by their number of words, then by place.
    """
    texts = len(ends) - 1
    text_of = np.repeat(np.arange(texts), np.diff(ends))
    names, numbers, owners = [pa.array(distinct, pa.large_string())], [codes], [text_of]
    longer, starts = codes.astype(np.int64), np.arange(len(codes))
    parts = distinct
    for n in range(2, most_words + 1):
        starts = starts[starts + n - 1 < ends[text_of[starts] + 1]]
        # A run is the run one word shorter from the same place, and one more word.
        pairs = longer[starts] * len(distinct) + codes[starts + n - 1]
        unique, which = np.unique(pairs, return_inverse=True)
        parts = [f"{parts[p // len(distinct)]} {distinct[p % len(distinct)]}" for p in unique.tolist()]
        longer = np.zeros(len(codes), np.int64)
        longer[starts] = which
        numbers.append(which + sum(map(len, names)))
        names.append(pa.array(parts, pa.large_string()))
        owners.append(text_of[starts])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=texts)
    return pa.concat_arrays(names), np.concatenate(numbers)[order], offsets_of(counts)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, buckets: int = BUCKETS, most_words: int = 1) -> DataFrame:
    """The buckets of every feature of every text, stored.

    Returns `doc_id, row, n_words, n_features, buckets` (unsigned numbers, little-endian, repeats
    included); `row` tells repeated rows apart. Null, empty and wordless texts have no features; a
    word of any length is one. Other columns are ignored.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("buckets", T.BinaryType()),
        ]
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_portions(batches, "text"):
            texts = batch.column("text").fill_null("").to_pylist()
            folded = [text.encode().translate(FOLDED).decode() for text in texts]
            distinct, codes, word_ends = coded_words(folded)
            names, numbers, ends = _runs(distinct, codes, word_ends, most_words)
            found = (crc32_of(names) % buckets).astype(_kind(buckets))[numbers]
            held, width = found.tobytes(), found.itemsize
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(word_ends).astype(np.int64)),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(
                        [held[a * width : b * width] for a, b in zip(ends, ends[1:], strict=False)],
                        pa.binary(),
                    ),
                ],
                schema.names,
            )
        release_memory()

    found = docs.select("doc_id", "text").mapInArrow(hashed, schema)
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "features")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: tasks add up their own, and the driver gets one sum per
    bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            held = b"".join(batch.column("buckets").to_pylist())
            sums += np.bincount(np.frombuffer(held, _kind(buckets)), minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["bucket", "n"])

    parts = found.select("buckets").mapInArrow(counted, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in sums:
        out[row["bucket"]] = row["n"]
    return out


# --- weights and draws --------------------------------------------------------------------------


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier a bucket is in the target, rounded down;
    one feature more is counted in every bucket of both."""
    here, there = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    ratios = ((t + 1) * here / ((s + 1) * there) for s, t in pairs)
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def draw_noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel variable, rounded down, that depends on seed and identifier alone. A
    missing identifier counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    most_words: int = 1,
    seed: int = 2024,
) -> DataFrame:
    """Draw `percent` in a hundred of the documents with at least `least_words` words.

    Returns `doc_id, n_features, weight, score, rank` for every row: drawn rows have ranks 1, 2, 3 and
    so on by falling score, then rising `doc_id` (none first), then any order; others have none.
    Documents without features weigh 0. Repeated rows are documents of their own. An empty table gives
    no rows; an empty target gives every bucket of the corpus its smoothed gain. Columns other than
    `doc_id` and `text` are ignored, of `target` all but `text`.
    """
    found = features(docs, buckets, most_words)
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, most_words)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))

    @F.pandas_udf(T.LongType())
    def weight(held: pd.Series) -> pd.Series:
        numbers = np.frombuffer(b"".join(held), _kind(buckets))
        ends = offsets_of(held.str.len() // np.dtype(_kind(buckets)).itemsize)
        return pd.Series(np.diff(np.concatenate(([0], np.cumsum(gain[numbers])))[ends]))

    scored = found.select(
        "doc_id", "row", "n_words", "n_features", weight("buckets").alias("weight")
    ).withColumn("score", F.col("weight") + draw_noise(F.col("doc_id"), seed))
    scored = staged(scored.withColumn("eligible", F.col("n_words") >= least_words), "scores")
    drawn = percent * scored.filter("eligible").count() // 100
    # The row number makes the order strict, so that no range holds more than its share.
    order = [F.desc("eligible"), F.desc("score"), F.asc("doc_id"), F.asc("row")]
    placed = total_before(scored, order, F.lit(1), "before")
    rank = F.when(F.col("eligible") & (F.col("before") < drawn), F.col("before") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
