"""Removing lines that many documents share, by a sharded minimal perfect hash over line digests.

1. Every document lists the digests of its distinct long lines. They are counted over all documents,
   combined before the shuffle, with the largest identifier that holds each.
2. The digests of repeated lines are divided into shards. A shard's digests get a minimal perfect hash,
   which numbers them without storing them, and arrays by that number: a fingerprint, the number of
   documents and the document that keeps the line.
3. The digests of the documents' lines are divided alike and probe the arrays of their shard; no line is
   joined. A shard with a line of very many documents is probed in parts, each with a copy of its arrays.
4. Only hits go back to the documents, which leave these lines out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import arrow_portions, mix, release_memory, staged
from faultline.session import attach

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3

# A shard has about this many digests, and about this many probes in one part of it.
SHARD_KEYS = 50_000
SHARD_PROBES = 100_000

# Bits of a level of the perfect hash for each digest that is not placed yet.
ROOM = 2.0

# What is stripped from lines.
EDGES = " \t\n\v\f\r"


# --- perfect hash -------------------------------------------------------------------------------


def halves(digests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of 16 bytes as two 64-bit numbers each."""
    held = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 2)
    return held[:, 0], held[:, 1]


@dataclass
class PerfectHash:
    """Numbers n known digests from 0 to n - 1.

    Each level is an array of bits. A digest that falls alone on a bit of a level sets it, and its
    number is the count of bits set before; those that meet others go on to the next level.
    """

    sizes: list[int]
    bits: np.ndarray

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(high ^ mix(low + salt)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """The digests must differ from each other."""
        sizes, levels = [], []
        while len(high):
            size = max(64, int(ROOM * len(high)))
            place = cls._place(high, low, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[place]
            high, low = high[left], low[left]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def number(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each digest; any number, or -1, for digests that were not there."""
        before = np.cumsum(self.bits) - self.bits
        out = np.full(len(high), -1, np.int64)
        open_, start = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            place = start + self._place(high[open_], low[open_], level, size)
            hit = self.bits[place]
            out[open_[hit]] = before[place[hit]]
            open_, start = open_[~hit], start + size
        return out


# --- index --------------------------------------------------------------------------------------

INDEX = (
    "shard long, parts long, sizes array<long>, bits binary, "
    "fingerprints binary, documents binary, named binary, keepers binary"
)


def _line_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """The lines of all texts, the text each lies in, and the key of each: stripped, A-Z lower-cased."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    return lines, owner, pc.ascii_lower(pc.utf8_trim(lines, EDGES))


def _digests(keys: pa.Array, least_chars: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Which keys are long enough, the digests of the distinct ones, and the number of each in them."""
    long = pc.greater_equal(pc.utf8_length(keys), least_chars).to_numpy(zero_copy_only=False)
    coded = keys.filter(pa.array(long)).dictionary_encode()
    digests = [xxhash.xxh3_128_digest(key) for key in coded.dictionary.cast(pa.large_binary()).to_pylist()]
    return np.flatnonzero(long), pa.array(digests, pa.binary()), coded.indices.to_numpy()


def line_digests(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row for each distinct line of a document with at least `least_chars` characters, stored.

    Returns `doc_id, content, digest`; `content` tells texts of the same `doc_id` apart.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("content", T.LongType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_portions(batches, "text"):
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            _, owner, keys = _line_parts(texts)
            places, digests, codes = _digests(keys, least_chars)
            pairs = np.unique(owner[places] * np.int64(len(digests) + 1) + codes)
            rows = pa.array(pairs // (len(digests) + 1))
            found = digests.take(pa.array(pairs % (len(digests) + 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("content").take(rows), found],
                schema.names,
            )
        release_memory()

    named = docs.select("doc_id", F.xxhash64("text").alias("content"), "text")
    return staged(named.mapInArrow(listed, schema), "line-digests")


def build_index(
    digests: DataFrame, least_documents: int = LEAST_DOCUMENTS
) -> tuple[DataFrame, int]:
    """The arrays of all shards, one row per shard, and the number of shards.

    Shards without a line of `least_documents` documents have no row.
    """
    repeated = staged(
        digests.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= least_documents),
        "repeated-lines",
    )
    shards = 1 + max(repeated.count() // SHARD_KEYS, digests.count() // SHARD_PROBES)

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        high, low = halves(table["digest"])
        found = PerfectHash.build(high, low)
        order = np.empty(len(high), np.int64)
        order[found.number(high, low)] = np.arange(len(high))
        counts = table["n"].to_numpy()
        keepers = table["keeper"].cast(pa.int64())
        row = {
            "shard": [table["shard"][0].as_py()],
            "parts": [1 + int(counts.sum()) // SHARD_PROBES],
            "sizes": [found.sizes],
            "bits": [np.packbits(found.bits).tobytes()],
            "fingerprints": [low[order].tobytes()],
            "documents": [counts[order].tobytes()],
            "named": [keepers.is_valid().to_numpy()[order].tobytes()],
            "keepers": [keepers.fill_null(0).to_numpy()[order].tobytes()],
        }
        return pa.table(row, SHARD_ROW)

    index = repeated.withColumn("shard", shard_of(shards)).groupBy("shard").applyInArrow(build, INDEX)
    return staged(index, "line-index"), shards


SHARD_ROW = pa.schema(
    [("shard", pa.int64()), ("parts", pa.int64()), ("sizes", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("bits", "fingerprints", "documents", "named", "keepers")]
)


def shard_of(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")


def shared_lines(
    digests: DataFrame, index: DataFrame, shards: int, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """The rows of `digests` whose line goes: shared by enough documents, and kept by another one."""
    # Every copy of a shard's arrays takes its part of the probes.
    many = index.select(F.col("shard").alias("shard"), F.col("parts").alias("_of"))
    placed = attach(digests.withColumn("shard", shard_of(shards)), many, "shard")
    probes = placed.filter(F.col("_of").isNotNull()).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "content"), F.col("_of"))
    )
    columns = digests.columns
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def probe(lines: pa.Table, arrays: pa.Table) -> pa.Table:
        lines = lines.select(columns).combine_chunks()
        if not lines.num_rows or not arrays.num_rows:
            return lines.slice(0, 0)
        row = arrays.slice(0, 1).to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(row["sizes"])].astype(bool)
        high, low = halves(lines["digest"])
        number = PerfectHash(row["sizes"], bits).number(high, low)
        there = np.flatnonzero(number >= 0)
        number = number[there]
        same = np.frombuffer(row["fingerprints"], "<u8")[number] == low[there]
        enough = np.frombuffer(row["documents"], "<i8")[number] >= least_documents
        named = np.frombuffer(row["named"], bool)[number]
        keepers = np.frombuffer(row["keepers"], "<i8")[number]
        own = lines["doc_id"].cast(pa.int64()).take(pa.array(there))
        keeps = named & own.is_valid().to_numpy() & (own.fill_null(0).to_numpy() == keepers)
        # Where no document has an identifier, all of them keep the line.
        return lines.take(pa.array(there[same & enough & named & ~keeps]))

    return (
        probes.groupBy("shard", "part")
        .cogroup(copies.groupBy("shard", "part"))
        .applyInArrow(probe, digests.schema)
    )


# --- documents ----------------------------------------------------------------------------------


def _without(
    texts: pa.Array, dropped: Iterable[list[bytes] | None], least_chars: int
) -> tuple[list[str], list[int], list[int]]:
    """The texts without their dropped lines, how many lines they had, and how many went."""
    lines, owner, keys = _line_parts(texts)
    counts = np.bincount(owner, minlength=len(texts))
    places, digests, codes = _digests(keys, least_chars)
    names = digests.to_pylist()
    lists = [set(some or ()) for some in dropped]
    gone = np.zeros(len(lines), bool)
    for place, code in zip(places.tolist(), codes.tolist(), strict=True):
        if names[code] in lists[owner[place]]:
            gone[place] = True
    went = np.bincount(owner[gone], minlength=len(texts))
    kept = texts.to_pylist()
    starts = np.cumsum(counts) - counts
    for i in np.flatnonzero(went).tolist():
        stay = np.flatnonzero(~gone[starts[i] : starts[i] + counts[i]]) + starts[i]
        kept[i] = "\n".join(lines.take(pa.array(stay)).to_pylist())
    return kept, counts.tolist(), went.tolist()


def remove_shared_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """Every text without the lines that it shares with enough other documents.

    A line counts by its key: without white space at its ends, A-Z lower-cased. Lines whose key has at
    least `least_chars` characters and lies in at least `least_documents` rows go from all of them, but
    for the rows with the largest `doc_id` that holds it. Returns `doc_id, n_lines, n_dropped, text`
    for every row. Null and empty texts are one empty line. Repeated rows count one by one and have equal
    results. Rows without a `doc_id` come before all others; lines that only such rows hold stay. An empty
    table gives no rows; other columns are ignored. `doc_id` must be a whole number.
    """
    digests = line_digests(docs, least_chars)
    index, shards = build_index(digests, least_documents)
    dropped = (
        shared_lines(digests, index, shards, least_documents)
        .groupBy("doc_id", "content")
        .agg(F.collect_set("digest").alias("_dropped"))
        .withColumnsRenamed({"doc_id": "_id", "content": "_content"})
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("text", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_portions(batches, "text"):
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            found = _without(texts, batch.column("_dropped").to_pylist(), least_chars)
            kept, counts, went = (
                pa.array(found[0], pa.string()),
                pa.array(found[1], pa.int64()),
                pa.array(found[2], pa.int64()),
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, went, kept], schema.names)
        release_memory()

    texts = docs.select("doc_id", "text")
    same = texts["doc_id"].eqNullSafe(dropped["_id"]) & (
        F.xxhash64(texts["text"]) == dropped["_content"]
    )
    joined = texts.join(dropped, same, "left").select("doc_id", "text", "_dropped")
    return joined.mapInArrow(cut, schema)
