"""Shards by a hierarchical tree of weighted hash draws: region, rack, shard.

At each level every child draws from the hash of (child, key), scaled by its weight, and the smallest
draw wins: a child wins in proportion to its weight, and a change of one weight moves keys only into
or out of that child. So movement is confined to the subtrees whose weights change.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import ranked


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


# Shards per rack, and racks per region, of the shards a tree starts with.
RACK_SHARDS = 4
REGION_RACKS = 2


def even_tree(shards: int, base: int = 16) -> list[Shard]:
    """A tree of equal shards; those after the first `base` stand in regions of their own.

    A shard that opens a region changes the weight of no older node below the root. Hence the tree
    of one more shard (from `base` on) takes keys only into the new shard.
    """
    per_region = RACK_SHARDS * REGION_RACKS
    regions = -(-base // per_region)
    return [
        Shard(s // per_region, s // RACK_SHARDS, s)
        if s < base
        else Shard(regions + s - base, -(-base // RACK_SHARDS) + s - base, s)
        for s in range(shards)
    ]


def _children(weights: dict[tuple[int, int], float]) -> Column:
    """Literal array of (parent, id, weight); children without weight take no part."""
    return F.array(
        *(
            F.struct(
                F.lit(parent).alias("parent"), F.lit(child).alias("id"), F.lit(float(w)).alias("w")
            )
            for (parent, child), w in sorted(weights.items())
            if w > 0
        )
    )


def _draw(children: Column, level: str, parent: Column | None, key: Column) -> Column:
    """The child of `parent` with the smallest -ln(u) / weight; ties go to the smaller id."""

    def score(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["id"], key), 11)
        u = (bits + F.lit(0.5)) / F.lit(2.0**53)
        return F.struct((-F.ln(u) / child["w"]).alias("score"), child["id"].alias("id"))

    here = children if parent is None else F.filter(children, lambda c: c["parent"] == parent)
    return F.array_min(F.transform(here, score))["id"]


def shard_of(df: DataFrame, key: str, tree: Sequence[Shard], name: str) -> DataFrame:
    """Add column `name`: the shard of each row. Rows of one key share it; null keys are one key.

    Weights must not all be 0; shard numbers are unique.
    """
    regions: dict[tuple[int, int], float] = {}
    racks: dict[tuple[int, int], float] = {}
    for s in tree:
        regions[0, s.region] = regions.get((0, s.region), 0) + s.weight
        racks[s.region, s.rack] = racks.get((s.region, s.rack), 0) + s.weight
    leaves = {(s.rack, s.shard): s.weight for s in tree}
    return (
        df.withColumn("_region", _draw(_children(regions), "region", None, F.col(key)))
        .withColumn("_rack", _draw(_children(racks), "rack", F.col("_region"), F.col(key)))
        .withColumn(name, _draw(_children(leaves), "shard", F.col("_rack"), F.col(key)))
        .drop("_region", "_rack")
    )


def place(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every document's shard, its place there, and its shard if there were one more.

    Returns `doc_id, size, text_crc32, law, shard, slot, grown_shard`, one row per input row. `size`
    is the bytes of the text plus 1; a null text has none, and checksum 0. `slot` numbers the rows of
    a shard from 0 without gaps. Rows with the same (or no) `doc_id` share a shard. Other columns
    of `docs` are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = shard_of(rows, "doc_id", even_tree(shards), "shard")
    rows = shard_of(rows, "doc_id", even_tree(shards + 1), "grown_shard")
    numbered = ranked(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard"
    )
