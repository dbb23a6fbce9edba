"""Exact deduplication with a cuckoo-filter index of live digests.

The index is divided into shards by digest. A shard holds a cuckoo filter of short fingerprints, and in
the slot of each fingerprint the stored key behind it: the full digest of the content, the row that stays,
and the number of live rows. A digest that the filter does not know is new without a look at the stored
keys; a hit is verified against the keys in the slots of its two buckets, and nowhere else. A key moves
with its fingerprint. When a fingerprint finds no place, the filter is built again with twice the buckets
from the stored keys. Deleting the last live row of a digest empties its slot.

Each insertion or deletion writes a new version of the index; a failed one leaves the old as it was.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import BLANKS, staged
from faultline.session import scratch_dir

SLOTS = 4
MOST_KICKS = 500
LEAST_BUCKETS = 64

# Distinct digests that one task holds in memory, at about 200 bytes each.
SHARD_KEYS = 200_000

KEYS = "shard int, digest binary, keep_id long, keep_row long, live long, slot int"
FILTERS = "shard int, buckets int, slots binary, stored long"


# A stored key: digest, identifier and row that stay, and number of live rows.
Key = list


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four, with what is stored behind each; a digest may lie in
    either of two buckets."""

    def __init__(self, buckets: int = LEAST_BUCKETS, slots: bytes | None = None, stored: int = 0):
        self.buckets = buckets
        marks = [0] * (buckets * SLOTS) if slots is None else np.frombuffer(slots, "<u2").tolist()
        self.slots: list[int] = marks
        self.held: list[Key | None] = [None] * len(marks)
        self.stored = stored

    def places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0) and the two buckets; the first bytes chose the shard already."""
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") % self.buckets
        return mark, first, self._other(mark, first)

    def _other(self, mark: int, bucket: int) -> int:
        # `buckets` is a power of two, so this undoes itself.
        return bucket ^ (mark * 0x5BD1E995 % self.buckets)

    def _matching(self, digest: bytes) -> Iterator[int]:
        """The slots with the fingerprint of a digest, in its two buckets."""
        mark, first, second = self.places(digest)
        for bucket in (first,) if first == second else (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[slot] == mark:
                    yield slot

    def hit(self, digest: bytes) -> bool:
        return any(True for _ in self._matching(digest))

    def find(self, digest: bytes) -> int | None:
        """The slot whose stored key is the digest: hits are compared in full."""
        for slot in self._matching(digest):
            key = self.held[slot]
            if key is not None and key[0] == digest:
                return slot
        return None

    def _free(self, bucket: int) -> int | None:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.slots[slot]:
                return slot
        return None

    def insert(self, key: Key) -> Key | None:
        """Store a key that is not there. The key that is left without a place, if one is: the filter must
        then be built anew from the stored keys and this one."""
        mark, first, second = self.places(key[0])
        self.stored += 1
        for bucket in (first, second):
            free = self._free(bucket)
            if free is not None:
                self.slots[free], self.held[free] = mark, key
                return None
        bucket = first
        for kick in range(MOST_KICKS):
            slot = bucket * SLOTS + kick % SLOTS
            mark, self.slots[slot] = self.slots[slot], mark
            key, self.held[slot] = self.held[slot], key
            bucket = self._other(mark, bucket)
            free = self._free(bucket)
            if free is not None:
                self.slots[free], self.held[free] = mark, key
                return None
        self.stored -= 1
        return key

    def remove(self, slot: int) -> None:
        self.slots[slot], self.held[slot] = 0, None
        self.stored -= 1

    def keys(self) -> list[tuple[int, Key]]:
        """The stored keys with their slots."""
        return [(slot, key) for slot, key in enumerate(self.held) if key is not None]


class Shard:
    """One shard while it is changed."""

    def __init__(self, keys: pd.DataFrame, filters: pd.DataFrame):
        if len(filters):
            f = filters.iloc[0]
            self.filter = CuckooFilter(int(f["buckets"]), f["slots"], int(f["stored"]))
        else:
            self.filter = CuckooFilter()
        columns = [keys[name].tolist() for name in ("slot", "digest", "keep_id", "keep_row", "live")]
        for slot, *key in zip(*columns, strict=True):
            self.filter.held[int(slot)] = key
        self.resizes = 0

    def insert(self, digest: bytes, keep: object, row: int, live: int) -> None:
        slot = self.filter.find(digest)
        if slot is None:
            homeless = self.filter.insert([digest, keep, row, live])
            if homeless is not None:
                self.grow(homeless)
            return
        known = self.filter.held[slot]
        if _before((keep, row), (known[1], known[2])):
            known[1], known[2] = keep, row
        known[3] += live

    def delete(self, digest: bytes, live: int) -> None:
        slot = self.filter.find(digest)
        if slot is None:
            return
        known = self.filter.held[slot]
        known[3] -= live
        if known[3] <= 0:
            self.filter.remove(slot)

    def grow(self, homeless: Key) -> None:
        """Twice the buckets, or more, for all stored keys and one that found no place."""
        keys = [*(key for _, key in self.filter.keys()), homeless]
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            self.resizes += 1
            if all(self.filter.insert(key) is None for key in keys):
                return

    def frame(self, shard: int) -> pd.DataFrame:
        """The keys as rows, and the filter as one row without a digest."""
        held = self.filter.keys()
        n = len(held)
        slots = np.asarray(self.filter.slots, "<u2").tobytes()
        return pd.DataFrame(
            {
                "shard": [shard] * (n + 1),
                "digest": [*(key[0] for _, key in held), None],
                "keep_id": pd.array([*(key[1] for _, key in held), None], "Int64"),
                "keep_row": pd.array([*(key[2] for _, key in held), None], "Int64"),
                "live": pd.array([*(key[3] for _, key in held), None], "Int64"),
                "slot": pd.array([*(slot for slot, _ in held), None], "Int32"),
                "buckets": pd.array([*[None] * n, self.filter.buckets], "Int32"),
                "slots": [*[None] * n, slots],
                "stored": pd.array([*[None] * n, self.filter.stored], "Int64"),
            }
        )


def _before(one: tuple, other: tuple) -> bool:
    """Smaller identifier first, none last, then the earlier row."""

    def rank(keep: object, row: int) -> tuple:
        return (bool(pd.isna(keep)), 0 if pd.isna(keep) else keep, row)

    return rank(*one) < rank(*other)


@dataclass(frozen=True)
class CuckooIndex:
    """A version of the index: a folder with both tables, and the number of shards."""

    spark: SparkSession
    shards: int
    path: str | None = None

    @classmethod
    def empty(cls, spark: SparkSession, expected: int) -> CuckooIndex:
        """An index for about `expected` distinct digests; more only make its tasks larger."""
        return cls(spark, max(1, -(-expected // SHARD_KEYS)))

    def keys(self) -> DataFrame:
        return self._read().filter("digest IS NOT NULL").select(*_names(KEYS))

    def filters(self) -> DataFrame:
        return self._read().filter("digest IS NULL").select(*_names(FILTERS))

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """Add rows of `digest, doc_id, row`."""
        return self._change(rows, lambda shard, r: shard.insert(r.digest, r.doc_id, r.row, r.n))

    def delete(self, rows: DataFrame) -> CuckooIndex:
        """Take rows of `digest, doc_id, row` out. The row that stays keeps its name while any row
        of its digest is live; digests that the index lacks are ignored."""
        return self._change(rows, lambda shard, r: shard.delete(r.digest, r.n))

    def _read(self) -> DataFrame:
        schema = f"{KEYS}, buckets int, slots binary, stored long"
        if self.path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _change(self, rows: DataFrame, step) -> CuckooIndex:
        shards = self.shards

        def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """One row per digest and batch, so that a hot digest sends few rows to its shard."""
            for frame in frames:
                ordered = frame.sort_values(["doc_id", "row"], na_position="last")
                groups = ordered.groupby("digest", sort=False)
                first = groups.head(1).set_index("digest")
                first["n"] = groups.size()
                first = first.reset_index()
                first["shard"] = [int.from_bytes(d[:8], "little") % shards for d in first["digest"]]
                yield first[["shard", "digest", "doc_id", "row", "n"]]

        def change(key: tuple, batch: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            is_key = old["digest"].notna()
            shard = Shard(old[is_key], old[~is_key])
            for r in batch.itertuples(index=False):
                step(shard, r)
            return shard.frame(key[0])

        batch = rows.select("digest", F.col("doc_id").cast("long").alias("doc_id"), "row").mapInPandas(
            combine, "shard int, digest binary, doc_id long, row long, n long"
        )
        schema = f"{KEYS}, buckets int, slots binary, stored long"
        changed = (
            batch.groupBy("shard").cogroup(self._read().groupBy("shard")).applyInPandas(change, schema)
        )
        path = scratch_dir(self.spark, "cuckoo")
        changed.write.parquet(path)
        return replace(self, path=path)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def content_digest(text: Column) -> Column:
    """SHA-256, in hex, of the text with each run of blanks as one space; null counts as empty."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")
    return F.sha2(spaced.cast("binary"), 256)


def digest_rows(docs: DataFrame) -> DataFrame:
    """Content digests of all rows, with a row number that stays as it is: `doc_id, digest, row`."""
    digest = F.unhex(content_digest(F.col("text")))
    row = F.monotonically_increasing_id()
    return staged(docs.select("doc_id", digest.alias("digest"), row.alias("row")), "digests")


def deduplicate(docs: DataFrame, expected: int | None = None) -> DataFrame:
    """Every row with the row of equal text that stays.

    Returns `doc_id, keep_id, group_size, kept, text_sha256`, one row per input row. Texts are equal
    if they are identical after each run of blanks is one space; null counts as empty. The smallest
    `doc_id` stays, rows without one only if no row has one; of rows that repeat exactly, one stays.
    `doc_id` is an integer. Other columns are ignored.
    """
    rows = digest_rows(docs)
    if expected is None:
        expected = rows.count()
    index = CuckooIndex.empty(docs.sparkSession, expected).insert(rows)
    # A hot digest is many rows on the left and one on the right, which a skew join can split.
    return rows.join(index.keys(), "digest").select(
        "doc_id",
        F.col("keep_id").cast(docs.schema["doc_id"].dataType).alias("keep_id"),
        F.col("live").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
