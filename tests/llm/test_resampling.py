"""Importance resampling against its definition, and checksums against the library."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex

from faultline.llm import resampling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_checksums_equal_the_library():
    rng = random.Random(1)
    sizes = [0, 1, 2, 3, 3, 7, 255, 256, 257, 511, 512, 513, 5000, 5000, 100_000]
    texts = ["".join(chr(rng.randrange(1, 128)) for _ in range(n)) for n in sizes] + ["é日本", "é日本"]
    found = resampling.crc32_of(pa.array(["cut", *texts], pa.large_string())[1:])
    assert found.tolist() == [zlib.crc32(t.encode()) for t in texts]


def buckets(text, n, most):
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % n for r in runs]


TEXTS = [None, "", "!! --", "One two, three3 É́ 日本語、x", "z" * 9000, "same same " * 30, "A_b`c{d~e\x7ff"]


@pytest.mark.parametrize("n, most", [(10_000, 1), (50, 1), (70_000, 3)])
def test_draw_equals_the_definition(spark, n, most):
    rng = random.Random(n)
    texts = TEXTS + [" ".join(rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(rng.randrange(60))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, score int")
    target = [("a1 b2 c3 " * 20,), (None,), ("j8 j8",)]
    got = resampling.resample(docs.repartition(4), spark.createDataFrame(target, "text string"), buckets=n, most_words=most).collect()
    found = {i: buckets(t, n, most) for i, t in rows}
    here = Counter(b for _, some in found.values() for b in some)
    there = Counter(b for (t,) in target for b in buckets(t, n, most)[1])
    s, t = here.total() + n, there.total() + n
    gain = [math.floor(1000 * math.log((there[b] + 1) * s / ((here[b] + 1) * t))) for b in range(n)]
    expected = {}
    for i, (_, some) in found.items():
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in some)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected[i] = [i, len(some), weight, weight + noise, None]
    able = sorted((i for i in found if found[i][0] >= 20), key=lambda i: (-expected[i][3], i))
    for rank, i in enumerate(able[: len(able) // 10]):
        expected[i][4] = rank + 1
    assert sorted(map(list, got)) == sorted(expected.values())


def test_edge_tables(spark):
    target = spark.createDataFrame([("w " * 5,)], "text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, target).count() == 0
    # Repeated rows and rows without an identifier: one rank each.
    docs = spark.createDataFrame([(None, "w " * 30)] * 40 + [(1, "w " * 30)] * 40, "doc_id long, text string")
    for wanted in (target, none.select("text")):
        rows = resampling.resample(docs, wanted, percent=50).collect()
        assert len(rows) == 80
        assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 41))


def test_gains_fall_with_the_corpus():
    found = resampling.gains(np.array([0, 5, 50]), np.array([3, 3, 3]))
    assert found[0] > found[1] > found[2]
