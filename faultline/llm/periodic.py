"""Runs of repetition in texts: maximal stretches of words that repeat with a smallest period.

Words of a portion of texts are numbered; the texts lie one after the other, each closed by a number of
its own. A run of period q is a maximal stretch in which words q apart are equal, at least two periods
long. Periods are searched by scale:

1. Periods below `DIRECT`: each lag is scanned directly, over all words.
2. Periods from P to 2P, P doubling: windows of P/4 words have hashes, and in every P/8 neighbouring
   windows the smallest ones are minimizers. Inside a run, equal windows lie one period apart, and their
   neighbours are equal too, so minimizers repeat at the distance of the period. Pairs of equal
   minimizers from P to 2P apart are seeds; a seed is extended word by word to both sides.
3. A window with a period of its own of at most P/16 would pair with too many others. It lies in a run that
   a lower scale has found, and is no seed. A run of the present scale whose minimizers are all of
   this kind consists of two runs of one short period, nearly touching (see `_joints`); seeds are set
   where their periods are in step.

A window that is in no such run recurs at most 32 times within 2P words, so seeds grow with the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import (
    arrow_portions,
    coded_words,
    mix,
    release_memory,
    words,
)

LEAST_LENGTH = 12

# The first scale: a power of two of at least 32, so that the shortest windows have several words.
DIRECT = 64

RUNS = "array<struct<start: long, length: long, period: long>>"

Found = list[tuple[int, int, int]]


# --- search -------------------------------------------------------------------------------------


def _streaks(hit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last place of every stretch of at least `least` trues."""
    places = np.flatnonzero(hit)
    if not len(places):
        return places, places
    breaks = np.flatnonzero(np.diff(places) > 1)
    first = places[np.concatenate(([0], breaks + 1))]
    last = places[np.concatenate((breaks, [len(places) - 1]))] + 1
    long = last - first >= least
    return first[long], last[long]


def _direct(x: np.ndarray, lags: range, least: int) -> Found:
    """The stretches of each lag as (start, end, lag), scanning every word."""
    out = []
    for lag in lags:
        if lag >= len(x):
            break
        first, last = _streaks(x[:-lag] == x[lag:], max(least - lag, lag))
        out += zip(first.tolist(), (last + lag).tolist(), [lag] * len(first), strict=True)
    return out


def _same_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words two arrays share."""
    size, start = min(len(a), len(b)), 0
    step = 64
    while start < size:
        end = min(size, start + step)
        unequal = np.flatnonzero(a[start:end] != b[start:end])
        if len(unequal):
            return start + int(unequal[0])
        start, step = end, min(2 * step, 1 << 20)
    return size


def _extend(x: np.ndarray, seeds: np.ndarray, least: int) -> Found:
    """The stretches that hold the seeds (place, lag); the words of a seed are equal."""
    out: Found = []
    seeds = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))]
    covered, before = -1, -1
    for place, lag in seeds.tolist():
        if lag == before and place < covered:
            continue
        ahead = _same_ahead(x[place:], x[place + lag :])
        back = _same_ahead(x[:place][::-1], x[: place + lag][::-1])
        before, covered = lag, place + ahead
        if ahead + back >= max(least - lag, lag):
            out.append((place - back, place + ahead + lag, lag))
    return out


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each `width` (a power of two) neighbours; one entry per first neighbour."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places whose hash is least in some `width` neighbours, equal ones all."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _least_of(hashes, width)
    # A place is least in one of the groups it lies in if the largest of their leasts is its own.
    edge = np.zeros(width - 1, np.uint64)
    largest = ~_least_of(~np.concatenate((edge, least, edge)), width)
    return np.flatnonzero(hashes == largest)


def _dull(runs: Found, window: int) -> Found:
    """The runs of which a window has a period of at most a quarter of it."""
    return [run for run in runs if run[2] <= window // 4 and run[1] - run[0] >= window]


def _pairs(hashes: np.ndarray, places: np.ndarray, scale: int) -> np.ndarray:
    """All pairs of equal windows whose distance is from `scale` to twice as much, as (place, lag)."""
    order = np.argsort(hashes[places], kind="stable")
    keys, sorted_places = hashes[places][order], places[order]
    out, open_ = [], np.arange(len(keys))
    apart = 1
    while True:
        open_ = open_[open_ + apart < len(keys)]
        open_ = open_[keys[open_] == keys[open_ + apart]]
        lags = sorted_places[open_ + apart] - sorted_places[open_]
        open_, lags = open_[lags < 2 * scale], lags[lags < 2 * scale]
        if not len(open_):
            break
        far = lags >= scale
        out.append(np.stack((sorted_places[open_[far]], lags[far]), axis=1))
        apart += 1
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _joints(x: np.ndarray, dull: Found, window: int, scale: int) -> np.ndarray:
    """Seeds for runs whose minimizers lie in two runs of one short period p.

    Let the run start at s with period q, w = window / 2 the number of neighbours. Its minimizers are at
    most w apart, so neighbouring ones share a run of period p, and one such run reaches from at most
    s + w to at least s + q - w, its copy from s + q + w on. Were both one run, the whole run had the
    period p. So the first ends before s + q + w + 2p, and the place `window` + 4p before its end is in it,
    and inside the copy one period on, where the words are the same again.
    """
    seeds = []
    by_period: dict[int, Found] = {}
    for run in sorted(dull):
        by_period.setdefault(run[2], []).append(run)
    for period, runs in by_period.items():
        starts = np.array([run[0] for run in runs])
        for start, end, _ in runs:
            place = end - window - 4 * period
            if place < start:
                continue
            near = np.arange(*np.searchsorted(starts, (end - 2 * period, end + window + 1)))
            for other in near.tolist():
                there, until, _ = runs[other]
                if there <= start:
                    continue
                # Where the period of the copy is in step, if it has the same words at all.
                for shift in range(period):
                    if until - there >= shift + period and np.array_equal(
                        x[place : place + period], x[there + shift : there + shift + period]
                    ):
                        steps = np.arange(there + shift, until - period + 1, period) - place
                        lags = steps[(steps >= scale) & (steps < 2 * scale)]
                        seeds.append(np.stack((np.full(len(lags), place), lags), axis=1))
                        break
    return np.concatenate(seeds) if seeds else np.zeros((0, 2), np.int64)


def runs_of(codes: np.ndarray, ends: np.ndarray, least: int = LEAST_LENGTH) -> Found:
    """All runs of all texts as (start, end, period) in `codes`, ordered by start, then period.

    `codes` are numbers from 0, `ends` where texts start and end, from 0 to the number of codes.
    """
    sizes = np.diff(ends)
    # Every text is followed by a number that occurs nowhere else.
    texts = len(sizes)
    x = np.empty(len(codes) + texts, np.int64)
    closing = ends[1:] + np.arange(texts)
    inner = np.ones(len(x), bool)
    inner[closing] = False
    x[inner], x[closing] = codes, -1 - np.arange(texts)
    origin = np.cumsum(inner) - inner

    best: dict[tuple[int, int], int] = {}

    def keep(found: Found, back: np.ndarray) -> None:
        """A stretch has all multiples of its period as lags: the smallest is found first or replaces."""
        for start, end, lag in found:
            span = int(back[start]), int(back[end - 1]) + 1
            best[span] = min(lag, best.get(span, lag))

    keep(_direct(x, range(1, DIRECT), least), np.arange(len(x)))
    place = np.arange(len(x))
    hashes = mix(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    room = np.repeat(sizes, sizes + 1)
    window, scale = 1, DIRECT
    while True:
        wide = room >= 2 * scale
        if not wide.any():
            break
        x, place, hashes, room = x[wide], place[wide], hashes[wide], room[wide]
        while window < scale // 4:
            # The hash of a window from those of its halves; windows past a text's end are of no use.
            after = np.concatenate((hashes[window:], np.zeros(min(window, len(x)), np.uint64)))
            hashes = mix(hashes * np.uint64(0xBF58476D1CE4E5B9) + mix(after ^ np.uint64(window)))
            window *= 2
        valid = hashes[: max(len(x) - window + 1, 0)]
        here = np.full(int(place[-1]) + 2, -1, np.int64)
        here[place] = np.arange(len(place))
        known = [
            (int(here[a]), int(here[a]) + b - a, p)
            for (a, b), p in best.items()
            if a < len(here) and here[a] >= 0
        ]
        dull = _dull(known, window)
        marks = np.zeros(len(x) + 1, np.int64)
        for start, end, _ in dull:
            marks[start] += 1
            marks[end - window + 1] -= 1
        places = _minimizers(valid, window // 2)
        places = places[np.cumsum(marks)[places] == 0]
        seeds = np.concatenate((_pairs(valid, places, scale), _joints(x, dull, window, scale)))
        # Words at a seed must be equal; windows with equal hashes are, but for chance.
        seeds = seeds[x[seeds[:, 0]] == x[seeds[:, 0] + seeds[:, 1]]]
        keep(_extend(x, seeds, least), place)
        scale *= 2
    return sorted((int(origin[a]), int(origin[b - 1]) + 1, p) for (a, b), p in best.items())


# --- documents ----------------------------------------------------------------------------------


def _folded(texts: list[str], least: int) -> tuple[list[list[tuple[int, int, int]]], list[str]]:
    """The runs of each text as (start, length, period), and its words without the repeats."""
    distinct, codes, ends = coded_words(texts)
    codes = codes.astype(np.int64)
    lists: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(codes, ends, least)
    owners = np.searchsorted(ends, [run[0] for run in found], side="right") - 1
    drops = np.zeros(len(codes) + 1, np.int64)
    for (start, end, period), owner in zip(found, owners.tolist(), strict=True):
        lists[owner].append((start - int(ends[owner]), end - start, period))
        drops[start + period] += 1
        drops[end] -= 1
    kept = np.cumsum(drops)[:-1] == 0
    left = pa.array(distinct, pa.large_string()).take(pa.array(codes[kept]))
    kept_ends = np.concatenate(([0], np.cumsum(kept)))[ends]
    by_text = pa.ListArray.from_arrays(pa.array(kept_ends.astype(np.int32)), left)
    joined = pc.binary_join(by_text, pa.scalar(" ", pa.large_string()))
    return lists, joined.to_pylist()


def collapse_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """The runs of every text, and the text with each run cut to its first period.

    Returns `doc_id, runs, text`: `runs` by start, then period, counted in words; `text` has its words
    joined by one space. A run has at least `least` words and two periods. Null and empty texts have no
    runs and an empty text; texts of any length are searched whole, each within one task. Repeated rows,
    and rows without a `doc_id`, have results of their own; an empty table gives no rows; other columns
    are ignored.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("runs", T._parse_datatype_string(RUNS)),
            T.StructField("text", T.StringType()),
        ]
    )
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_portions(batches, "text"):
            lists, texts = _folded(batch.column("text").fill_null("").to_pylist(), least)
            flat = [run for some in lists for run in some]
            values = pa.StructArray.from_arrays(
                [pa.array([run[i] for run in flat], pa.int64()) for i in range(3)],
                fields=list(kind.value_type),
            )
            ends = np.concatenate(([0], np.cumsum([len(some) for some in lists])))
            runs = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values, type=kind)
            columns = [batch.column("doc_id"), runs, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(search, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text`, every tenth text (by a checksum of `doc_id`) changed: from some word on, its
    words repeat with a period that its number of words and the checksum decide. Texts without a `doc_id`
    and texts without a word stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text").withColumns(
        {"_h": h, "_words": F.when(h % 10 == 0, words(F.col("text")))}
    )
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    start = F.when(n > 0, g % n).cast("int")
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("int")
    sized = split.withColumns({"_a": start, "_p": period})
    block = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((n - F.col("_a")) / F.col("_p")).cast("int")
    repeated = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.flatten(F.array_repeat(block, times)))
    changed = F.array_join(F.slice(repeated, F.lit(1), n), " ")
    text = F.when(n > 0, changed).otherwise(F.col("text"))
    return sized.select("doc_id", text.alias("text"))


def run_text(runs: Column) -> Column:
    """All runs as lines `start,length,period`."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))


def longest_run(runs: Column) -> Column:
    """The run with the greatest length; the smallest start, then period, wins ties."""
    keyed = F.transform(
        runs,
        lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run")),
    )
    return F.array_min(keyed)["run"]
