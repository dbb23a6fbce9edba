"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its three-word shingles. Its sketch has one coordinate per bin. In round
after round every shingle is thrown into a bin; the first round to reach a bin fills it, with the
smallest hash thrown. After as many rounds as there are bins, each further round throws all shingles
into one bin, so every coordinate of every set is filled, and two sets agree in a coordinate with the
probability of their similarity, with the concentration of independent draws.

Bands of coordinates put similar documents into common buckets. Documents with the same set are one
class, and classes of a bucket are compared on their full sets: first each with one hub, and then only
classes that no chain of links connects yet and that a bound does not rule out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import (
    NOT_BLANKS,
    by_portion,
    coded_words,
    keep_rows,
    mix,
    portions,
    staged,
)
from faultline.session import scratch_dir

SHINGLE = 3
BANDS = 30
ROWS = 8
PERCENT = 85

# Groups of one hub with at most this many members are compared pair by pair.
SMALL_GROUP = 16

_NEVER = np.uint64(2**64 - 1)


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text.

    Only A-Z is lower-cased. A text of fewer words is one shingle, one without words has none.
    """
    distinct, codes, ends = coded_words(texts)
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(word.encode().lower()) for word in distinct),
        np.uint64,
        len(distinct),
    )[codes]
    sets = []
    for start, end in zip(ends, ends[1:], strict=False):
        words = hashes[start:end]
        if not len(words):
            sets.append(words)
            continue
        n = min(width, len(words))
        total = len(words) - n + 1
        # The number of words is part of the hash, so that short texts differ from shingles.
        joined = np.full(total, n, np.uint64)
        for i in range(n):
            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + words[i : i + total])
        sets.append(np.unique(joined))
    return sets


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """The filled coordinates of a set that is not empty: round and smallest hash of each bin."""
    out = np.full(bins, _NEVER)
    # Several rounds at once for small sets; which round fills a bin is the same either way.
    together = max(1, min(2 * bins, 4 * bins // len(shingles)))
    for start in range(0, 2 * bins, together):
        rounds = np.arange(start, min(start + together, 2 * bins), dtype=np.uint64)
        thrown = mix(shingles[None, :] ^ mix(rounds + np.uint64(1))[:, None])
        target = np.where(
            rounds[:, None] < bins, thrown % np.uint64(bins), rounds[:, None] % np.uint64(bins)
        )
        value = (rounds[:, None] << np.uint64(54)) | (mix(thrown) >> np.uint64(10))
        np.minimum.at(out, target.ravel().astype(np.int64), value.ravel())
        if out.max() != _NEVER:
            break
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for column in coordinates.reshape(bands, -1).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def sketches(docs: DataFrame, width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`doc_id, content, n_shingles, set, bands` per row: a hash of the text, a digest of the set, and one
    key per band.

    Without words, `set` is null and there are no bands.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("content", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def compute(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text").fill_null("").to_pylist(), width)
        keys = [band_keys(sketch(s, bands * rows), bands) if len(s) else [] for s in sets]
        columns = [
            batch.column("doc_id"),
            batch.column("content"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    named = docs.select("doc_id", _content().alias("content"), "text")
    return named.mapInArrow(by_portion(compute), schema)


def _content() -> Column:
    """A hash that tells the texts of one `doc_id` apart."""
    return F.xxhash64("text")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets_of(texts: DataFrame, width: int) -> DataFrame:
    """`set, shingles` of the rows of `set, text`; rows whose text has another set are dropped."""

    def compute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text"):
            sets = shingle_sets(frame["text"].tolist(), width)
            same = [_digest(s) == wanted for s, wanted in zip(sets, frame["set"], strict=True)]
            yield pd.DataFrame(
                {"set": frame["set"].to_numpy(), "shingles": [s.view(np.int64) for s in sets]}
            )[same]

    return texts.mapInPandas(compute, "set binary, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """The connected components of links `a, b`: every linked node with the smallest of its component.

    Large-star and small-star steps alternate until no link changes. Returns `node, root`.
    """
    links = edges.select("a", "b").distinct().checkpoint()
    seen = None
    while True:
        for small in (False, True):
            both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            if small:
                both = both.filter(F.col("b") < F.col("a"))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            moved = both.join(least, "a")
            if small:
                # Smaller neighbours, and the node itself, go to the smallest.
                moved = moved.select(F.col("b").alias("x"), "m").unionAll(
                    least.select(F.col("a").alias("x"), "m")
                )
            else:
                moved = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "m")
            links = (
                moved.filter(F.col("x") != F.col("m"))
                .select(F.col("m").alias("a"), F.col("x").alias("b"))
                .distinct()
            )
        links = links.checkpoint()
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(
    docs: DataFrame,
    width: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Every row with the component of near-duplicates that it belongs to.

    Returns `doc_id, n_shingles, component_id, kept`, one row per input row. Rows are linked if their
    sets share at least `percent` of their union; `component_id` is the smallest `doc_id` that links
    reach, `kept` says that it is the row's own. Rows without words or text are linked with nothing.
    Rows without a `doc_id` take part; a component of such rows alone has none. Repeated rows get
    the same result. Other columns are ignored.
    """
    sketched, rooted = _rooted(docs, width, percent, bands, rows)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("set", "component_id")
    # A hot set is many rows on the left and one on the right, which a skew join can split.
    alone = sketched.filter("set IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        sketched.filter("set IS NOT NULL")
        .join(found, "set")
        .select("doc_id", "n_shingles", "component_id")
        .unionAll(alone)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, all its columns as they are: the one with the smallest `doc_id`, rows
    without one last, then the smallest hash of its text. Of rows equal in both any stays. Rows
    without words or text all stay."""
    sketched, rooted = _rooted(docs, SHINGLE, percent, BANDS, ROWS)
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content")).alias("one")
    chosen = (
        sketched.filter("set IS NOT NULL")
        .join(rooted.select("set", "root"), "set")
        .groupBy("root")
        .agg(one)
        .select("one.doc_id", "one.content")
    )
    wordless = F.col("text").isNull() | ~F.col("text").rlike(NOT_BLANKS)
    grouped = keep_rows(docs, chosen, _content(), "content")
    return grouped.unionAll(docs.filter(wordless))


def _rooted(
    docs: DataFrame, width: int, percent: int, bands: int, rows: int
) -> tuple[DataFrame, DataFrame]:
    """The sketches, and the component of every set: `set, first, root`."""
    _checkpoint_dir(docs)
    sketched = staged(sketches(docs, width, bands, rows), "sketches")
    # Rows with the same set are one class; copies meet before the shuffle where they can.
    classes = (
        sketched.filter("set IS NOT NULL")
        .groupBy("set")
        .agg(
            F.min("doc_id").alias("first"),
            F.min(F.struct("doc_id", "content")).alias("one"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    # The hub of a bucket is the class with the most company in all its buckets, which is likely to
    # be the text that the others were edited from. Which bucket it was does not matter any more.
    keyed = classes.select("set", "n", F.explode("bands").alias("key"))
    crowds = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1")
    crowded = staged(keyed.join(crowds, "key"), "crowded")
    company = crowded.groupBy("set").agg(F.sum("crowd").alias("company"))
    hubs = (
        crowded.join(company, "set")
        .groupBy("key")
        .agg(F.max(F.struct("company", "set", "n")).alias("hub"))
    )
    members = staged(
        crowded.join(hubs, "key")
        .filter(F.col("set") != F.col("hub.set"))
        .select(F.col("hub.set").alias("hub"), F.col("hub.n").alias("hub_n"), "set", "n")
        .distinct(),
        "members",
    )
    involved = members.select("set").unionAll(members.select("hub")).distinct()
    wanted = classes.join(involved, "set").select(
        "set", F.col("one.doc_id").alias("_id"), F.col("one.content").alias("_content")
    )
    texts = (
        docs.select("doc_id", "text")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (_content() == F.col("_content")))
        .select("set", "text")
    )
    sets = staged(_sets_of(texts, width).dropDuplicates(["set"]), "sets")

    with_hub = members.filter(_possible("n", "hub_n", percent))
    links = _verified(with_hub.select(F.col("hub").alias("a"), F.col("set").alias("b")), sets, percent)
    labels = components(links).withColumnRenamed("node", "set")
    rooted = members.join(labels, "set", "left").withColumn("root", F.coalesce("root", "set"))
    open_pairs = _open_pairs(rooted.select("hub", "set", "n", "root"), sets, percent)
    more = _verified(open_pairs, sets, percent)
    labels = components(links.unionAll(more))

    rooted = classes.select("set", "first").join(
        labels.withColumnRenamed("node", "set"), "set", "left"
    ).withColumn("root", F.coalesce("root", "set"))
    return sketched, rooted


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _open_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a hub, may be similar enough, and are not connected yet: `a, b`.

    Groups (of one hub) whose members are all connected need nothing. In small groups all pairs
    across components are taken. In large groups most members are edits of the same text, and pairs
    are found by what each member adds to the shingles that most of the group have (its core):

    * two sets share at most the smaller of their core parts, and what they both add. If they add
      nothing in common, the smaller core part alone must reach the share that is asked for;
    * otherwise they must add at least a certain number of shingles in common, so one of these is
      among the rarest of either set (prefix filtering).

    No pair that is similar enough is lost, whatever the core is.
    """
    # Counted per component first, so that no task holds all components of a hub.
    parts = members.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("size"))
    groups = parts.groupBy("hub").agg(
        F.sum("size").alias("size"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.max(F.struct("size", "root"))["root"].alias("main"),
    )
    open_ = members.join(groups.filter("low != high").select("hub", "size", "main"), "hub")
    open_ = staged(open_, "open")
    small = open_.filter(F.col("size") <= SMALL_GROUP).select("hub", "set", "n", "root")

    # --- what each member of a large group adds
    large = open_.filter(F.col("size") > SMALL_GROUP).join(sets, "set")
    rows = large.select("hub", "size", "main", "set", "n", "root", F.explode("shingles").alias("x"))
    held = rows.groupBy("hub", "x").agg(F.count(F.lit(1)).alias("holders"))
    member = Window.partitionBy("hub", "set")
    measured = rows.join(held, ["hub", "x"]).withColumn(
        "added", F.count_if(2 * F.col("holders") < F.col("size")).over(member)
    )
    core = F.col("n") - F.col("added")
    least_other = F.ceil(F.col("n") * percent / 100)
    needed = F.ceil((F.col("n") + least_other) * percent / (100 + percent)) - core
    rarest = F.row_number().over(member.orderBy("holders", "x"))
    ranked = staged(
        measured.withColumns({"core": core, "rank": rarest}).filter(
            (F.col("rank") == 1)
            | (
                (2 * F.col("holders") < F.col("size"))
                & (F.col("holders") > 1)
                & (F.col("rank") <= F.col("added") - F.greatest(needed, F.lit(1)) + 1)
            )
        ),
        "prefixes",
    )
    added = ranked.filter((2 * F.col("holders") < F.col("size")) & (F.col("holders") > 1)).select(
        "hub", "x", "set", "n", "root", "main"
    )
    cores = ranked.filter((F.col("rank") == 1) & (100 * F.col("core") >= percent * F.col("n")))
    cores = cores.select("hub", "set", "n", "root", "main", "core")

    def pairs(rows: DataFrame, keys: list[str], one_side: Column | None, test: Column) -> DataFrame:
        """Pairs across components; where one component prevails, one of a pair is outside it."""
        one, two = rows.alias("one"), rows.alias("two")
        if one_side is not None:
            one = one.filter(one_side)
        condition = (
            (F.col("one.root") != F.col("two.root"))
            & _possible("one.n", "two.n", percent)
            & test
        )
        for key in keys:
            condition &= F.col(f"one.{key}") == F.col(f"two.{key}")
        return one.join(two, condition).select(
            F.least("one.set", "two.set").alias("a"), F.greatest("one.set", "two.set").alias("b")
        )

    outside = F.col("root") != F.col("main")
    enough = (100 + percent) * F.least("one.core", "two.core") >= percent * (
        F.col("one.n") + F.col("two.n")
    )
    return (
        pairs(small, ["hub"], None, F.col("one.set") < F.col("two.set"))
        .unionAll(pairs(added, ["hub", "x"], outside, F.lit(True)))
        .unionAll(pairs(cores, ["hub"], outside, enough))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, stored."""
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    checked = (
        pairs.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("y")), "b")
        .join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), "a")
        .filter(100 * shared >= percent * union)
        .select("a", "b")
    )
    return staged(checked, "links")


def _checkpoint_dir(df: DataFrame) -> None:
    """Checkpoints go where the cluster says; a session without a folder gets one of its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
