"""Runs of repetition against a search over all lags."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import periodic


def all_runs(words, least):
    best = {}
    for lag in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - lag:
            j = i
            while j < len(words) - lag and words[j] == words[j + lag]:
                j += 1
            if j + lag - i >= max(least, 2 * lag):
                best.setdefault((i, j + lag), lag)
            i = max(j, i + 1)
    return sorted((start, end, lag) for (start, end), lag in best.items())


def fibonacci(rng, n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def broken_periods(rng, n):
    unit, out = [rng.randrange(2) for _ in range(rng.randrange(1, 6))], []
    while len(out) < n:
        out += unit * rng.randrange(1, 120) + unit[: rng.randrange(len(unit))]
        out += [rng.randrange(3)] if rng.random() < 0.5 else []
    return out


def two_blocks(rng, n):
    blocks, out = [[0] * rng.randrange(1, 200) + [k] for k in (1, 2)], []
    while len(out) < n:
        out += rng.choice(blocks)
    return out


def copied(rng, n):
    out = [rng.randrange(rng.choice([1, 3, 500])) for _ in range(n)]
    for _ in range(3):
        i, j = sorted(rng.randrange(len(out) + 1) for _ in range(2))
        out = (out[:j] + out[i:j] * rng.randrange(1, 3) + out[j:])[:1200]
    return out


MAKERS = [
    fibonacci,
    broken_periods,
    two_blocks,
    copied,
    lambda rng, n: [0] * n,
    lambda rng, n: [rng.randrange(2) for _ in range(n)],
    lambda rng, n: [bin(i).count("1") % 2 for i in range(n)],
]


@pytest.mark.parametrize("direct", [32, 64])
@pytest.mark.parametrize("maker", MAKERS)
def test_runs_equal_all_lags(monkeypatch, direct, maker):
    monkeypatch.setattr(periodic, "DIRECT", direct)
    rng = random.Random(direct)
    for least in (2, 5, 12) * 3:
        texts = [maker(rng, rng.randrange(700)) for _ in range(3)]
        ends = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        codes = np.array([c for t in texts for c in t], np.int64)
        expected = [
            (a + int(at), b + int(at), p)
            for t, at in zip(texts, ends, strict=False)
            for a, b, p in all_runs(t, least)
        ]
        assert periodic.runs_of(codes, ends, least) == sorted(expected)


def test_seeds_do_not_grow_with_the_square_of_a_dull_text():
    """A text of one word, and one whose short period breaks once, give few seeds at every scale."""
    for n in (20_000, 80_000):
        for text in ([0] * n, [0, 1] * (n // 4) + [0] + [0, 1] * (n // 4)):
            made = []
            extend = periodic._extend

            def counted(x, seeds, least, made=made, extend=extend):
                made.append(len(seeds))
                return extend(x, seeds, least)

            periodic._extend = counted
            try:
                periodic.runs_of(np.array(text, np.int64), np.array([0, len(text)]))
            finally:
                periodic._extend = extend
            assert sum(made) <= n


TEXTS = [
    None,
    "",
    " \t\n",
    "a",
    "a b " * 10,
    "x y z x y z x y z x y z x y z tail of words",
    "tail " + "one two three four five six seven " * 3 + "end",
    " ".join(f"w{i % 150}" for i in range(700)),
    "long " * 5000,
]


def test_texts_are_collapsed(spark):
    rows = [(i, t, "l", "r") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], "l", "r"), (4, TEXTS[4], "l", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start string")
    got = periodic.collapse_runs(docs).collect()
    assert len(got) == len(rows)
    expected = {}
    for doc_id, text, *_ in rows:
        words = (text or "").split()
        found, drop = all_runs(words, 12), set()
        for start, end, period in found:
            drop.update(range(start + period, end))
        runs = [(a, b - a, p) for a, b, p in found]
        expected[doc_id] = runs, " ".join(w for i, w in enumerate(words) if i not in drop)
    assert all(([tuple(x) for x in r.runs], r.text) == expected[r.doc_id] for r in got)
    assert periodic.collapse_runs(docs.limit(0)).count() == 0


def test_planted_texts_and_columns(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(f"v{(i * j) % 97}" for j in range(i % 90))) for i in range(300)] + [(None, "a b"), (7, None)],
        "doc_id long, text string",
    )
    changed = 0
    for before, after in zip(docs.collect(), periodic.with_planted_runs(docs).collect(), strict=True):
        words = (before.text or "").split()
        h = zlib.crc32(str(before.doc_id).encode()) if before.doc_id is not None else 1
        if h % 10 or not words:
            assert after == before
            continue
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert after.text.split(" ") == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        changed += after.text != before.text
    assert changed > 5
    runs = spark.createDataFrame([([(5, 12, 3), (9, 12, 2), (1, 4, 1)],), ([],)], f"runs {periodic.RUNS}")
    top, none = runs.select(
        periodic.longest_run(F.col("runs")).alias("top"), periodic.run_text(F.col("runs")).alias("text")
    ).collect()
    assert tuple(top.top) == (5, 12, 3) and top.text == "5,12,3\n9,12,2\n1,4,1\n"
    assert none.top is None and none.text == ""
    assert hashlib.sha256(none.text.encode()).hexdigest().startswith("e3b0c442")
