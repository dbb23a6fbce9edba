"""Shared lines against a table of all lines."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from faultline.llm import line_dedup

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows):
    holders, keyed = defaultdict(list), []
    for doc_id, text in rows:
        keys = [line.strip(" \t\n\v\f\r").translate(LOWER) for line in (text or "").split("\n")]
        keyed.append(keys)
        for key in set(keys):
            if len(key) >= 20:
                holders[key].append(doc_id)
    out = Counter()
    for (doc_id, text), keys in zip(rows, keyed, strict=True):
        gone = []
        for key in keys:
            found = holders.get(key, [])
            keeper = max((x for x in found if x is not None), default=None)
            gone.append(len(found) >= 3 and keeper is not None and doc_id != keeper)
        lines = (text or "").split("\n")
        left = "\n".join(line for line, g in zip(lines, gone, strict=True) if not g)
        out[doc_id, len(lines), sum(gone), left] += 1
    return out


def some_rows():
    rng = random.Random(3)
    pool = [f"Line number {i} with Some words in it" for i in range(40)]
    pool += ["short", "", " \t", "x" * 30, "É" * 19, "É" * 20, " " + "y" * 25]
    rows = []
    for i in range(300):
        lines = [rng.choice(["", "\t", " "]) + rng.choice(pool) + rng.choice(["", "\r"]) for _ in range(rng.randint(1, 9))]
        rows.append((rng.choice([i, i % 7, None]), "\n".join(line.swapcase() if rng.random() < 0.2 else line for line in lines)))
    rows += [(None, None), (5, ""), (1, "q\n" * 4000), (-9, "only rows without a number\n" * 2)]
    # A line that only rows without an identifier hold.
    return rows + [(None, "held by nobody in particular")] * 4


@pytest.mark.parametrize("keys, probes", [(50_000, 100_000), (3, 20)])
def test_shared_lines_equal_a_table_of_lines(spark, monkeypatch, keys, probes):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", probes)
    rows = some_rows()
    docs = spark.createDataFrame([(*r, "s", "p") for r in rows], "doc_id long, text string, shard string, digest string")
    got = line_dedup.remove_shared_lines(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == expected(rows)
    assert line_dedup.remove_shared_lines(docs.limit(0)).count() == 0


def test_a_hot_line_is_probed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 100)
    rows = [(i, f"the line that every text holds\nown line of text number {i}") for i in range(2000)]
    digests = line_dedup.line_digests(spark.createDataFrame(rows, "doc_id long, text string"))
    index, shards = line_dedup.build_index(digests)
    assert shards == 41 and [r.parts for r in index.collect()] == [21]
    gone = line_dedup.shared_lines(digests, index, shards).collect()
    assert sorted(r.doc_id for r in gone) == list(range(1999))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
    # Digests that differ in one half only.
    high[: n // 2] = 7
    found = line_dedup.PerfectHash.build(high, low)
    assert sorted(found.number(high, low).tolist()) == list(range(n))
    assert len(found.bits) <= 64 * 12 + 6 * n
    strangers = found.number(*rng.integers(0, 2**63, (2, 1000)).astype(np.uint64))
    assert (strangers >= -1).all() and (strangers < max(n, 1)).all()
