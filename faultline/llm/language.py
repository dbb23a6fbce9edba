"""Language identification of mixed texts.

Words are scored by hashed character n-grams against every language that writes in their script; a
Viterbi pass over the words of a text, with a penalty for each switch, labels spans of one language.
The language of a text is the one whose spans hold most of its letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import (
    PORTION_CHARS,
    by_portion,
    coded_words,
    gather,
    held_out,
    mix,
    offsets_of,
    portions,
)

# N-grams are hashed into this many buckets: the model has as many numbers per language.
BUCKETS = 1 << 16
# At most about this many documents per language are learned from, chosen by a hash.
SAMPLE_ROWS = 20_000
# Price of a switch, in nats: about what one clear word is worth.
SWITCH = 8.0
# A language writes in a script if at least this share of its training words do.
SCRIPT_SHARE = 0.01
# What a word costs in a language that does not write in its script.
FOREIGN = 30.0
# Longer runs without a blank are scored in parts, so that they weigh like so many words.
WORD_CHARS = 40
UNKNOWN = "und"

# First and last code point of ranges of letters, by script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
NAMES = [*SCRIPTS, "other"]

_RANGES = np.array(sorted((a, b, i) for i, r in enumerate(SCRIPTS.values()) for a, b in r))


def scripts_of(points: np.ndarray) -> np.ndarray:
    """The position in `NAMES` of the script of each code point."""
    i = np.searchsorted(_RANGES[:, 0], points, side="right") - 1
    inside = (i >= 0) & (points <= _RANGES[i, 1])
    return np.where(inside, _RANGES[i, 2], len(NAMES) - 1)


def _letters(word: str) -> str:
    if not word.isascii():
        word = unicodedata.normalize("NFC", word)
    if word.isalpha():
        return word.lower()
    return "".join(c for c in word if c.isalpha()).lower()


class Words:
    """The words of a portion of texts: the distinct ones, and what the model needs of them.

    `codes` numbers the words of all texts in order, `ends` cuts them into texts. A distinct word has
    a number of letters, a script (-1 without letters), and n-gram buckets (`grams`, by `owners`).
    """

    def __init__(self, texts: list[str]):
        distinct, self.codes, self.ends = coded_words(texts)
        if any(len(word) > WORD_CHARS for word in distinct):
            distinct = self._part(distinct)
        keys: dict[str, int] = {}
        self.codes = np.fromiter(
            (keys.setdefault(_letters(word), len(keys)) for word in distinct), np.int64, len(distinct)
        )[self.codes]
        self.sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        self._hash("".join(f"<{key}>" for key in keys))

    def _part(self, distinct: list[str]) -> list[str]:
        """Cut long words into parts, in the distinct words and in the texts."""
        numbers: dict[str, int] = {}
        parts = [
            [
                numbers.setdefault(word[i : i + WORD_CHARS], len(numbers))
                for i in range(0, len(word), WORD_CHARS)
            ]
            for word in distinct
        ]
        offsets = offsets_of(map(len, parts))
        sizes = np.concatenate(([0], np.cumsum(np.diff(offsets)[self.codes])))
        flat = np.fromiter((n for part in parts for n in part), np.int64, int(offsets[-1]))
        self.codes, self.ends = gather(offsets, flat, self.codes), sizes[self.ends]
        return list(numbers)

    def _hash(self, marked: str) -> None:
        """Buckets of the n-grams of two to four characters, ends included, and of the whole word."""
        points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
        lengths = np.where(self.sizes > 0, self.sizes + 2, 0)
        points = points[np.repeat(self.sizes > 0, self.sizes + 2)]
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(self.sizes)), lengths)
        self.scripts = np.full(len(self.sizes), -1)
        some = self.sizes > 0
        self.scripts[some] = scripts_of(points[starts[some] + 1].astype(np.int64))

        found, owners = [], []
        rolling = mix(points)
        for n in (2, 3, 4):
            rolling = mix(rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :])
            inside = owner[: len(rolling)] == owner[n - 1 :]
            found.append(rolling[inside])
            owners.append(owner[: len(rolling)][inside])
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        spread = mix(points + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        if some.any():
            found.append(mix(np.add.reduceat(spread, starts[some])))
            owners.append(np.flatnonzero(some))
        self.owners = np.concatenate(owners)
        self.grams = (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages in order of name, log probabilities by bucket, and the scripts each writes in."""

    languages: list[str]
    weights: np.ndarray
    writes: np.ndarray

    def word_scores(self, words: Words) -> np.ndarray:
        """One row per distinct word. Words without letters speak for no language, and words of a
        script that no language writes in may be of any."""
        sums = np.stack(
            [
                np.bincount(words.owners, column[words.grams], len(words.sizes))
                for column in self.weights.T
            ],
            axis=1,
        )
        narrowed = self.writes[words.scripts]
        foreign = ~narrowed & narrowed.any(axis=1, keepdims=True) & (words.scripts >= 0)[:, None]
        return sums - FOREIGN * foreign

    def label(self, words: Words, switch: float = SWITCH) -> list[np.ndarray]:
        """The language of every word of every text, by position in `languages`."""
        codes = [words.codes[a:b] for a, b in zip(words.ends, words.ends[1:], strict=False)]
        if not self.languages:
            return [np.zeros(len(code), np.int8) for code in codes]
        return viterbi(self.word_scores(words), codes, switch)


def viterbi(scores: np.ndarray, codes: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """The best path through the word scores of each text; all texts advance word by word together."""
    order = np.argsort([-len(c) for c in codes], kind="stable")
    lengths = np.array([len(codes[i]) for i in order], np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    kinds = scores.shape[1]
    if not longest or not kinds:
        return [np.zeros(len(c), np.int8) for c in codes]
    flat = np.concatenate([codes[i] for i in order])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")

    value = np.zeros((len(lengths), kinds))
    stays = np.empty((len(flat), kinds), bool)
    comes_from = np.empty(len(flat), np.int8)
    for t in range(longest):
        n = active[t]
        now = value[:n]
        at = starts[:n] + t
        best = now.argmax(axis=1)
        moved = now[np.arange(n), best][:, None] - switch
        stay = now >= moved
        stays[at] = stay
        comes_from[at] = best
        value[:n] = np.where(stay, now, moved) + scores[flat[at]]
    state = value.argmax(axis=1).astype(np.int8)
    path = np.empty(len(flat), np.int8)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        here = state[:n]
        path[at] = here
        state[:n] = np.where(stays[at, here], here, comes_from[at])
    out: list[np.ndarray] = [path[:0]] * len(codes)
    for i, start, length in zip(order, starts, lengths, strict=True):
        out[i] = path[start : start + length]
    return out


def fit(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, portion: int = PORTION_CHARS
) -> Model:
    """Learn from the rows with a text and a language that are not held out.

    The counts of a language come from at most about `sample_rows` documents of it, those with the
    smallest hashes. Only counts per language and bucket, or script, come to the driver. Tasks take
    texts in portions of so many characters: smaller ones take less memory and more time, with the
    same result.
    """
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)) & F.col("lang").isNotNull()
    )
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(NAMES), 0), bool))
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_rows / n))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.filter(F.col("text").isNotNull() & (draw < F.element_at(share, F.col("lang"))))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in portions(frames, "text", portion):
            for lang, part in frame.groupby("lang"):
                words = Words(part["text"].tolist())
                times = np.bincount(words.codes, minlength=len(words.sizes))
                buckets = np.bincount(words.grams, times[words.owners], BUCKETS)
                scripts = np.bincount(words.scripts + 1, times, len(NAMES) + 1)[1:]
                values = np.concatenate((buckets, scripts))
                keys = np.flatnonzero(values)
                yield pd.DataFrame({"lang": lang, "key": keys, "n": values[keys].astype(np.int64)})

    counted = (
        sample.select("text", "lang")
        .mapInPandas(count, "lang string, key int, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(sizes)
    numbers = {lang: j for j, lang in enumerate(languages)}
    counts = np.zeros((BUCKETS + len(NAMES), len(languages)))
    counts[counted["key"], counted["lang"].map(numbers).astype(int)] = counted["n"]
    seen = counts[:BUCKETS] + 0.5
    scripts = counts[BUCKETS:]
    writes = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, np.log(seen / seen.sum(axis=0)), writes)


def predict(
    docs: DataFrame,
    model: Model,
    prefix: str = "",
    spans: bool = False,
    portion: int = PORTION_CHARS,
) -> DataFrame:
    """Add the language of every text: columns `lang_pred` and `score`, after `prefix`.

    `score` is the share of the letters that lie in spans of that language; of languages with equal
    shares the first by name is taken. Null texts, texts without letters, and all texts under a
    model without languages are `und` with score 0. With `spans`, `spans` lists the labelled runs
    of words (first word, number of words, language). All other columns stay as they are. Tasks
    take texts in portions of so many bytes, as `fit` does.
    """
    names = [f"{prefix}lang_pred", f"{prefix}score"]
    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    if spans:
        names.append(f"{prefix}spans")
        span = "array<struct<start:int,words:int,lang:string>>"
        fields.append(T.StructField(names[2], T.DataType.fromDDL(span)))
    schema = T.StructType([*docs.schema.fields, *fields])
    parts = [("start", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct(parts))][: len(names)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        words = Words(batch.column("text").fill_null("").to_pylist())
        rows = []
        sizes = words.sizes[words.codes]
        for start, path in zip(words.ends, model.label(words), strict=False):
            letters = np.bincount(path, sizes[start : start + len(path)], len(model.languages))
            total = letters.sum() if len(letters) else 0
            if not total:
                rows.append((UNKNOWN, 0.0, []))
                continue
            best = int(letters.argmax())
            runs = []
            if spans:
                edges = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [len(path)]))
                runs = [
                    {"start": int(a), "words": int(b - a), "lang": model.languages[path[a]]}
                    for a, b in zip(edges, edges[1:], strict=False)
                ]
            rows.append((model.languages[best], float(letters[best] / total), runs))
        columns = list(zip(*rows, strict=True))
        added = [
            pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=False)
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return docs.mapInArrow(by_portion(label, most=portion), schema)


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the rows that are not held out, and predict every row from its text alone.

    Returns `doc_id, held_out, lang_pred, score`, one row per input row. Rows without a `doc_id` are
    not held out. Other columns are ignored.
    """
    model = fit(docs, sample_rows)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
