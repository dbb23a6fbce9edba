"""License scans: notices found in texts by MinHash over overlapping windows, then verified exactly.

A text is a sequence of three-word shingles (the shortest notices have five words, so that longer
shingles would leave nothing to measure). Windows of eight shingles start every four; each has one
minimum per band. A window meets a notice in the index if they agree in any band. The number of bands
follows from the least similarity that a window holding a notice can have, so that a notice is missed
with a probability of at most `miss`. Candidates are confirmed by the share of the notice's shingles
that the text holds. Licenses of one family share most of a notice, so that the words that tell a
notice from its siblings must stand in the text as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import ascii_lower
from faultline.llm.notices import FAMILIES, MORE_NOTICES

SHINGLE = 3
STEP = 4
SPAN = 2 * STEP

LEAST_CONTAINMENT = 0.8
MISS = 0.001

# Short notices of well-known licenses, as authors write them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
    "use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


ALL_NOTICES = {**NOTICES, **MORE_NOTICES}

# The words that tell siblings apart count with so many shingles before them.
LEAD = 2


def with_shingles(df: DataFrame) -> DataFrame:
    """Add `_shingles`: hashes of the three-word shingles of the text, in order.

    Words are runs of letters and digits; a text of fewer than three has no shingle.
    """
    found = F.regexp_extract_all(
        ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)
    )
    at = F.sequence(F.lit(0), F.size("_hashes") - SHINGLE)
    joined = F.transform(
        at, lambda i: F.xxhash64(*(F.get(F.col("_hashes"), i + k) for k in range(SHINGLE)))
    )
    none = F.array().cast("array<bigint>")
    return (
        df.withColumn("_hashes", F.transform(found, lambda w: F.xxhash64(w)))
        .withColumn("_shingles", F.when(F.size("_hashes") >= SHINGLE, joined).otherwise(none))
        .drop("_hashes")
    )


def band_count(least_shingles: int, miss: float = MISS) -> int:
    """Bands of one minimum each, so that a window holding the shortest notice is missed rarely."""
    similarity = min(least_shingles, SPAN) / SPAN
    return 1 if similarity == 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


def _masks(bands: int) -> list[int]:
    """One fixed 64-bit number per band; the order of x ^ mask is the band's order of shingles."""
    step = 0x9E3779B97F4A7C15
    numbers = []
    for band in range(1, bands + 1):
        z = band * step % 2**64
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        z ^= z >> 31
        numbers.append(z - 2**64 if z >= 2**63 else z)
    return numbers


def minima(part: Column, masks: Column) -> Column:
    """The smallest of the (at most `STEP`) shingles of a block, in the order of each mask."""
    return F.transform(
        masks, lambda m: F.least(*(F.get(part, F.lit(k)).bitwiseXOR(m) for k in range(STEP)))
    )


def telling_runs(
    known: Mapping[str, list[int]], families: Iterable[Iterable[str]]
) -> dict[str, list[int]]:
    """Per notice the shortest run of its shingles in which it parts from each of its siblings.

    Where a notice parts from a sibling, the first `SHINGLE` shingles that the sibling lacks count, as
    authors vary what follows. A run starts `LEAD` shingles early, so that it is not met at another
    place of a text by chance.
    """
    telling: dict[str, set[int]] = {name: set() for name in known}
    for family in families:
        members = [name for name in family if name in known]
        for name in members:
            for other in members:
                if other != name:
                    telling[name] |= _parting(known[name], set(known[other]))
    runs = {}
    for name, sequence in known.items():
        places = sorted(telling[name])
        runs[name] = sequence[max(0, places[0] - LEAD) : places[-1] + 1] if places else []
    return runs


def _parting(sequence: list[int], other: set[int]) -> set[int]:
    places, length = set(), 0
    for i, x in enumerate(sequence):
        length = 0 if x in other else length + 1
        if 0 < length <= SHINGLE:
            places.add(i)
    return places


def scan(
    docs: DataFrame,
    notices: Mapping[str, str] = ALL_NOTICES,
    containment: float = LEAST_CONTAINMENT,
    miss: float = MISS,
    families: Iterable[Iterable[str]] = FAMILIES,
) -> DataFrame:
    """The notices that each text holds: `doc_id, license, containment, shared, start_word`.

    One row per input row and notice of which the text holds at least a share `containment` of the
    shingles, and the words that tell it from its siblings in `families` in one run; texts without
    one, null and empty texts give no row. `start_word` is the word (from 0) where the first shared
    shingle starts. Repeated rows give repeated results. The list of notices
    is a parameter, and the plan holds it whole; notices need three words. The scan reads each text
    once and shuffles nothing. Other columns of `docs` are ignored.
    """
    known = _notice_shingles(docs.sparkSession, notices)
    masks = _masks(band_count(min(len(set(s)) for s in known.values()), miss))
    index: dict[int, set[int]] = {}
    for number, sequence in enumerate(known.values()):
        for start in range(max(1, len(sequence) - SPAN + 1)):
            for mask in masks:
                low = min(x ^ mask for x in sequence[start : start + SPAN])
                index.setdefault(low, set()).add(number)

    mask_array = F.array(*(F.lit(m) for m in masks))
    last = F.greatest(F.floor((F.size("_shingles") - 1) / STEP), F.lit(0)).cast("int")
    blocks = F.sequence(F.lit(0), last)
    parts = F.transform(blocks, lambda b: F.slice(F.col("_shingles"), b * STEP + 1, STEP))
    block_minima = F.transform(parts, lambda part: minima(part, mask_array))
    # A window is a block and the one after it, so its minima are the lesser of theirs. Only windows
    # with a minimum of a block in the index can have one of their own there.
    known_minimum = lambda x: x.isin(list(index))
    near = F.filter(
        F.transform("_blocks", lambda low, b: F.when(F.exists(low, known_minimum), b)),
        lambda b: b.isNotNull(),
    )
    starts = F.array_distinct(
        F.flatten(F.transform("_near", lambda b: F.array(F.greatest(b - 1, F.lit(0)), b)))
    )

    def window(b: Column) -> Column:
        low, following = F.get(F.col("_blocks"), b), F.get(F.col("_blocks"), b + 1)
        return F.coalesce(F.zip_with(low, following, lambda x, y: F.least(x, y)), low)

    met = F.array_distinct(
        F.flatten(F.transform(starts, lambda b: F.filter(window(b), known_minimum)))
    )
    lookup = F.create_map(
        *(
            item
            for low, numbers in index.items()
            for item in (F.lit(low), F.array(*(F.lit(n) for n in sorted(numbers))))
        )
    )
    names = F.array(*(F.lit(name) for name in known))
    templates = F.array(*(F.array(*(F.lit(x) for x in sorted(set(s)))) for s in known.values()))
    tells = telling_runs(known, families)
    runs = F.array(
        *(F.array(*(F.lit(x) for x in tells[name])).cast("array<bigint>") for name in known)
    )

    # Texts that meet no notice leave at the explosion below: a filter here would be pushed under
    # the steps above, and compute them twice.
    candidates = (
        with_shingles(docs.select("doc_id", "text"))
        .withColumn("_blocks", block_minima)
        .withColumn("_near", near)
        .withColumn("_met", met)
        .select("doc_id", "_shingles", "_met")
    )
    numbers = F.array_distinct(F.flatten(F.transform("_met", lambda x: F.element_at(lookup, x))))
    shared = F.size(F.array_intersect("_template", "_shingles"))
    first = F.array_min(
        F.filter(
            F.transform(
                "_shingles", lambda x, i: F.when(F.array_contains(F.col("_template"), x), i)
            ),
            lambda i: i.isNotNull(),
        )
    )
    at = F.sequence(F.lit(0), F.greatest(F.size("_shingles") - F.size("_run"), F.lit(0)))
    told_apart = (F.size("_run") == 0) | F.exists(
        at,
        lambda i: (F.get(F.col("_shingles"), i) == F.get(F.col("_run"), F.lit(0)))
        & (F.slice(F.col("_shingles"), i + 1, F.size("_run")) == F.col("_run")),
    )
    return (
        candidates.withColumn("_number", F.explode(numbers))
        .withColumn("_template", F.get(templates, F.col("_number")))
        .withColumn("shared", shared)
        .withColumn("containment", F.col("shared") / F.size("_template"))
        .filter(F.col("containment") >= containment)
        .withColumn("_run", F.get(runs, F.col("_number")))
        .filter(told_apart)
        .select(
            "doc_id",
            F.get(names, F.col("_number")).alias("license"),
            "containment",
            F.col("shared").cast("long"),
            first.cast("long").alias("start_word"),
        )
    )


def _notice_shingles(spark: SparkSession, notices: Mapping[str, str]) -> dict[str, list[int]]:
    """The shingles of the notices, hashed as those of the texts; as many rows as notices."""
    df = spark.createDataFrame(list(notices.items()), "license string, text string")
    rows = with_shingles(df).collect()
    return {row["license"]: row["_shingles"] for row in sorted(rows, key=lambda r: r["license"])}
