from __future__ import annotations

import math
import random

import pytest

from faultline.operators.thresholds import magnitude_threshold, major_events, mark_major
from helpers import collect, readings


def brute(values, q):
    ordered = sorted(values)
    return ordered[max(math.ceil(q * len(ordered)), 1) - 1]


def spread(kind, n, rng):
    return {
        "uniform": [rng.random() for _ in range(n)],
        "mostly_zero": [0.0 if rng.random() < 0.85 else round(rng.random() * 9, 2) for _ in range(n)],
        "outlier": [rng.gauss(0, 1) for _ in range(n - 2)] + [1e300, -1e12],
        "close": [1.0 + i * math.ulp(1.0) for i in range(n)],
        "scales": [10.0 ** rng.randint(-300, 300) for _ in range(n)],
        "constant": [3.25] * n,
    }[kind]


@pytest.mark.parametrize("kind", ["uniform", "mostly_zero", "outlier", "close", "scales", "constant"])
def test_exact_for_any_distribution(spark, kind):
    rng = random.Random(kind)
    values = spread(kind, 500, rng)
    df = readings(spark, [(0, "a", True, v, 1.0) for v in values])
    for q in (0.5, 0.9):
        assert collect(magnitude_threshold(df, q)) == [(brute(values, q),)]


def test_each_entity_has_its_own(spark):
    rng = random.Random(1)
    rows = [(0, e, True, rng.random() * k, 1.0) for e, k in (("a", 1), ("b", 1000)) for _ in range(211)]
    rows += [(0, "c", True, 7.0, 1.0), (0, None, True, 1e9, 1.0), (0, "c", True, None, 1.0)]
    got = dict(collect(magnitude_threshold(readings(spark, rows), entity="ville")))
    for e in "abc":
        assert got[e] == brute([r[3] for r in rows if r[1] == e and r[3] is not None], 0.9)
    assert set(got) == set("abc")


def test_few_bins_take_more_passes_to_the_same_value(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(0, e, True, rng.expovariate(1), 1.0) for e in "ab" for _ in range(300)]
    df = readings(spark, rows)
    expected = collect(magnitude_threshold(df, entity="ville"), "ville")
    monkeypatch.setattr("faultline.operators.thresholds.BINS", 8)
    monkeypatch.setattr("faultline.operators.thresholds.NARROWING", 30)
    assert collect(magnitude_threshold(df, entity="ville"), "ville") == expected


def test_major_is_strictly_above(spark):
    df = readings(spark, [(0, "a", True, 2.0, 1.0)] * 10)
    assert major_events(df, magnitude_threshold(df)).count() == 0


def test_rows_without_a_threshold_stay_and_are_not_major(spark):
    df = readings(spark, [(0, "a", True, 2.0, 1.0), (0, None, True, 9.0, 1.0), (0, "b", True, None, 1.0)])
    marked = mark_major(df, magnitude_threshold(df, entity="ville"), "ville")
    assert collect(marked.select("majeur"), "event_id") == [(False,), (None,), (None,)]


def test_infinite_and_nan_values_end_the_search(spark):
    values = [float("nan"), float("inf"), float("-inf"), *range(1, 18)]
    df = readings(spark, [(0, "a", True, float(v), 1.0) for v in values])
    assert collect(magnitude_threshold(df, 0.5)) == [(9.0,)]


@pytest.mark.parametrize("odd", [math.inf, math.nan])
def test_nothing_is_above_infinity_or_nan(spark, odd):
    df = readings(spark, [(0, "a", True, 1.0, 1.0)] * 15 + [(0, "a", True, odd, 1.0)] * 5)
    threshold = magnitude_threshold(df, 0.9)
    assert str(collect(threshold)[0][0]) == str(odd)
    assert major_events(df, threshold).count() == 0


def test_rank_is_exact(spark):
    df = readings(spark, [(0, "a", True, float(v), 1.0) for v in range(1, 101)])
    assert collect(magnitude_threshold(df, 0.55)) == [(55.0,)]


def test_at_most_five_passes(spark, monkeypatch):
    from faultline.operators import thresholds

    passes = []
    stage = thresholds.stage
    monkeypatch.setattr(thresholds, "stage", lambda df: passes.append(1) or stage(df))
    values = [10.0 ** (-300 + i) for i in range(600)] + [1.0 + i * math.ulp(1.0) for i in range(600)]
    df = readings(spark, [(0, "a", True, v, 1.0) for v in values])
    for q in (0.3, 0.5, 0.9):
        passes.clear()
        assert collect(magnitude_threshold(df, q)) == [(brute(values, q),)]
        assert len(passes) <= 5


def test_beyond_the_broadcast_limit_the_join_is_the_same(spark, monkeypatch):
    rows = [(i, e, True, float(i), 1.0) for i in range(100) for e in "abc"]
    df = readings(spark, rows)
    threshold = magnitude_threshold(df, entity="ville")
    small = collect(mark_major(df, threshold, "ville"), "event_id")
    monkeypatch.setattr("faultline.session.MAX_BROADCAST_ROWS", 1)
    marked = mark_major(df, threshold, "ville")
    assert "ResolvedHint" not in marked._jdf.queryExecution().analyzed().toString()
    assert collect(marked, "event_id") == small
    assert collect(magnitude_threshold(df, entity="ville"), "ville") == collect(threshold, "ville")


def stored(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "stored"))
    return spark.read.parquet(str(tmp_path / "stored"))


def scans(monkeypatch):
    """The passes over the values: every one ends in a stored result."""
    from faultline.operators import thresholds

    passes, stage = [], thresholds.stage
    monkeypatch.setattr(thresholds, "stage", lambda df: passes.append(1) or stage(df))
    return passes


@pytest.mark.parametrize("kind", ["uniform", "mostly_zero", "outlier", "close", "scales", "constant"])
@pytest.mark.parametrize("sample", [400, 200_000])
def test_a_sample_brackets_the_rank_in_two_scans(spark, tmp_path, monkeypatch, kind, sample):
    monkeypatch.setattr("faultline.operators.thresholds.SAMPLE", sample)
    rng = random.Random(kind)
    values = spread(kind, 3000, rng)
    df = stored(spark, readings(spark, [(0, "ab"[i % 2], True, v, 1.0) for i, v in enumerate(values)]), tmp_path)
    passes = scans(monkeypatch)
    for q in (0.1, 0.9):
        passes.clear()
        assert collect(magnitude_threshold(df, q)) == [(brute(values, q),)]
        # The bracket is a subquery of the scan that counts.
        assert len(passes) == 1
        got = dict(collect(magnitude_threshold(df, q, "ville")))
        assert got == {e: brute(values[i::2], q) for i, e in enumerate("ab")}


def test_a_bracket_that_misses_the_rank_takes_at_most_five_scans(spark, tmp_path, monkeypatch):
    narrow = spark.createDataFrame([(0.5, 0.6)], "lo double, hi double")
    monkeypatch.setattr("faultline.operators.thresholds._bracket", lambda sample, keys, q: narrow)
    values = [10.0 ** (-300 + i) for i in range(600)] + [math.inf, math.nan] * 5 + [-math.inf]
    df = stored(spark, readings(spark, [(0, "a", True, v, 1.0) for v in values]), tmp_path)
    passes = scans(monkeypatch)
    ordered = sorted(values, key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
    for q in (0.001, 0.5, 0.985):
        passes.clear()
        expected = ordered[max(math.ceil(q * len(ordered)), 1) - 1]
        assert collect(magnitude_threshold(df, q)) == [(expected,)]
        assert 2 < len(passes) <= 5


def test_many_values_inside_the_bracket_are_ranked_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("faultline.operators.thresholds.BINS", 20)
    rng = random.Random(9)
    rows = [(0, e, True, round(rng.random(), 3), 1.0) for e in "abc" for _ in range(700)]
    df = stored(spark, readings(spark, rows), tmp_path)
    got = dict(collect(magnitude_threshold(df, 0.9, "ville")))
    assert got == {e: brute([r[3] for r in rows if r[1] == e], 0.9) for e in "abc"}
    assert collect(magnitude_threshold(df, 0.2)) == [(brute([r[3] for r in rows], 0.2),)]
