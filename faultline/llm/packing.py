"""Packing documents into sequences by cutting-stock column generation.

1. Texts are tokenised; a document longer than a sequence is cut at multiples of the sequence length.
2. The histogram of piece lengths, in steps of `QUANTUM` tokens, is the demand of a cutting-stock
   problem. Its linear program over patterns (how many pieces of each length share a sequence) starts
   with one pattern per length; a knapsack dynamic program finds the pattern of the best price, until
   the bound on what any further pattern could save is below `GAP`.
3. Pattern counts are rounded down; what is left is filled by subset sums.
4. The pieces of a length are ranked, and each rank has its place in a pattern. The histogram and the
   patterns are bounded by the sequence length, however many documents there are.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import (
    by_portion,
    coded_words,
    gather,
    offsets_of,
    ranked,
    staged,
)

CAPACITY = 4096
QUANTUM = 8
END_ID = 2

# The linear program may stay above its bound by this share.
GAP = 1e-3

# Words whose ids a Python worker remembers, as columns: some tens of megabytes.
CACHE_WORDS = 400_000
CACHE_BYTES = 40
# Words in one line for the tokenizer, and lines that it is given at a time: what it returns takes
# about a hundred bytes per token.
LINE_WORDS = 500
LINES = 20
# Bytes of texts that are split at a time: distinct words are fewer in larger portions.
SPLIT_BYTES = 4_000_000
# Fixed value: how the vocabulary marks the end of a word.
WORD_END = "</w>"

# Marks that the tokenizer never joins to letters before them.
ENDINGS = ".,;:!?"

Pattern = dict[int, int]


# --- pieces -------------------------------------------------------------------------------------


class WordIds:
    """The ids of words by a tokenizer that drops white space and never merges across it.

    Known words are one column of texts and one of ids, which Arrow searches as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The last token of each pre-token carries the mark of a word's end.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known = pa.array([], pa.large_string())
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words: where those of each start and end, and all of them."""
        places = pc.index_in(words, self.known)
        missing = places.is_null()
        fresh = words.filter(missing)
        sizes, ids = self._encoded(fresh)
        start = len(self.known)
        places = pc.fill_null(places, 0).to_numpy().astype(np.int64)
        places[missing.to_numpy(zero_copy_only=False)] = start + np.arange(len(fresh))
        every = offsets_of(np.concatenate((self.sizes, sizes)))
        found = gather(every, np.concatenate((self.ids, ids)), places)
        self._remember(words, fresh, sizes, ids)
        return offsets_of(np.diff(every)[places]), found

    def _remember(self, words: pa.Array, fresh: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        short = pc.less_equal(pc.binary_length(fresh), CACHE_BYTES).to_numpy(zero_copy_only=False)
        if len(self.known) + len(fresh) > CACHE_WORDS:
            # Of the words known before, those that are still in use.
            used = pc.is_in(self.known, words).to_numpy(zero_copy_only=False)
            if used.sum() + len(fresh) > CACHE_WORDS:
                used[:] = False
            self._keep(used)
        offsets = offsets_of(sizes)
        kept = np.flatnonzero(short)[:CACHE_WORDS]
        self.known = pa.concat_arrays([self.known, fresh.take(pa.array(kept))])
        self.ids = np.concatenate((self.ids, gather(offsets, ids, kept)))
        self.sizes = np.concatenate((self.sizes, sizes[kept]))

    def _keep(self, used: np.ndarray) -> None:
        self.ids = gather(offsets_of(self.sizes), self.ids, np.flatnonzero(used))
        self.known, self.sizes = self.known.filter(pa.array(used)), self.sizes[used]

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids in order.

        Words of letters alone are one pre-token each, so many of them are encoded as one text. Some
        letters fall apart when lower-cased; a line with one of them has too many ends, and its words
        are encoded one by one.
        """
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        single = [np.flatnonzero(~letters)]
        plain = np.flatnonzero(letters)
        texts = words.take(pa.array(plain)).to_pylist()
        sizes = np.zeros(len(words), np.int64)
        order, parts = [], []
        lines = [slice(i, i + LINE_WORDS) for i in range(0, len(plain), LINE_WORDS)]
        batch = self._encode(" ".join(texts[line]) for line in lines)
        for line, ids in zip(lines, batch, strict=True):
            places, ends = plain[line], np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(places):
                single.append(places)
                continue
            sizes[places] = np.diff(ends, prepend=0)
            order.append(places)
            parts.append(ids[: ends[-1]])
        single = np.concatenate(single)
        alone = words.take(pa.array(single)).to_pylist()
        for place, ids in zip(single.tolist(), self._encode(alone), strict=True):
            sizes[place] = len(ids)
            parts.append(ids)
        # The ids are in the order of the lines; put them into that of the words.
        order = np.concatenate([*order, single]).astype(np.int64)
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        flat = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        return sizes, gather(offsets_of(sizes[order]), flat, back)

    def _encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        for some in batched(texts, LINES):
            for encoding in self.tokenizer.encode_batch_fast(list(some), add_special_tokens=False):
                yield np.asarray(encoding.ids, "<u4")


@functools.cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _tails(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The last `sizes` characters of each word, which take one byte each."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset :][1 : len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    ends = offsets_of(sizes)
    places = np.arange(ends[-1]) + np.repeat(offsets - ends[1:], sizes)
    return pa.LargeStringArray.from_buffers(
        len(words), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[places])
    )


def token_ids(texts: pa.Array | list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts: where those of each start and end, and all of them in order.

    Each distinct word is encoded once. A word of letters and marks after them is two parts, which are
    pre-tokens of their own; other words are one part. A-Z are lower-cased here already, since the
    tokenizer does so too.
    """
    distinct, codes, ends = coded_words(texts)
    words = pa.array(distinct, pa.large_string())
    letters = pc.utf8_rtrim(words, ENDINGS)
    plain = pc.utf8_is_alpha(letters)
    heads = pc.ascii_lower(pc.if_else(plain, letters, words))
    cut = (pc.binary_length(words).to_numpy() - pc.binary_length(letters).to_numpy()).astype(np.int64)
    cut[~plain.to_numpy(zero_copy_only=False)] = 0
    tails = _tails(words, cut)
    parts = pa.concat_arrays([heads, tails]).dictionary_encode()
    offsets, flat = _word_ids(path).of(parts.dictionary)
    # Head and tail of each word, then the words of all texts.
    pairs = parts.indices.to_numpy().reshape(2, -1).T.ravel()
    of_pairs = gather(offsets, flat, pairs)
    lengths = np.diff(offsets)[pairs].reshape(-1, 2).sum(axis=1)
    of_words = offsets_of(lengths)
    before = np.concatenate(([0], np.cumsum(lengths[codes])))
    return before[ends], gather(of_words, of_pairs, codes)


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
    portion: int = SPLIT_BYTES,
) -> DataFrame:
    """The ids of every document with an end id, in pieces of at most `capacity`.

    Returns `doc_id, start, length, doc_tokens, ids_crc32`, and `with_ids` the `ids` as well
    (little-endian unsigned 32-bit numbers, of which `ids_crc32` is the checksum). Null and empty texts
    have the end id alone. Repeated rows give repeated pieces.
    """
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *(T.StructField(name, T.LongType()) for name in ("start", "length", "doc_tokens", "ids_crc32")),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ]
    schema = T.StructType(fields)

    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends, ids = token_ids(batch.column("text").fill_null(""), path)
        held, bounds = memoryview(ids.astype("<u4").tobytes()), ends.tolist()
        rows, starts, sizes, totals, sums, kept = [], [], [], [], [], []
        for row, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
            total = last - first + 1
            for start in range(0, total, capacity):
                size = min(capacity, total - start)
                at = first + start
                piece = bytes(held[4 * at : 4 * min(at + size, last)])
                if at + size > last:
                    piece += end
                rows.append(row)
                starts.append(start)
                sizes.append(size)
                totals.append(total)
                sums.append(zlib.crc32(piece))
                if with_ids:
                    kept.append(piece)
        numbers = [pa.array(column, pa.int64()) for column in (starts, sizes, totals, sums)]
        columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), *numbers]
        return pa.RecordBatch.from_arrays(
            [*columns, *([pa.array(kept, pa.binary())] if with_ids else [])], schema.names
        )

    return docs.select("doc_id", "text").mapInArrow(by_portion(cut, most=portion), schema)


# --- patterns -----------------------------------------------------------------------------------


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, Pattern]:
    """The pattern of the highest price that fits, by dynamic programming over the room."""
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c], k = best[c - 1], fitting[c]
        if k:
            values = best[c - sizes[:k]] + prices[:k]
            i = int(values.argmax())
            if values[i] > best[c] + 1e-12:
                best[c], pick[c] = values[i], i
    pattern: Counter = Counter()
    c = room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[int(pick[c])] += 1
            c -= int(sizes[pick[c]])
    return float(best[room]), dict(pattern)


def generate_columns(
    sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP
) -> list[tuple[Pattern, float]]:
    """Patterns and how often each is used, by the revised simplex method with column generation.

    Patterns count pieces by position in `sizes` (ascending). Any dual prices bound the optimum from
    below by z / (price of the best pattern), which is where the search may stop.
    """
    n = len(sizes)
    columns: list[Pattern] = [{i: room // int(sizes[i])} for i in range(n)]
    inverse = np.diag([1 / columns[i][i] for i in range(n)])
    used = inverse @ demand
    for step in range(1, 50 * n + 1):
        prices = inverse.sum(axis=0)
        value, pattern = best_pattern(sizes, np.maximum(prices, 0), room)
        if value <= 1 + gap:
            break
        entering = np.zeros(n)
        for i, times in pattern.items():
            entering[i] = times
        change = inverse @ entering
        limits = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        leaving = int(limits.argmin())
        columns[leaving] = pattern
        row = inverse[leaving] / change[leaving]
        inverse -= np.outer(change, row)
        inverse[leaving] = row
        if step % 200 == 0:
            basis = np.zeros((n, n))
            for j, column in enumerate(columns):
                for i, times in column.items():
                    basis[i, j] = times
            inverse = np.linalg.inv(basis)
        used = np.maximum(inverse @ demand, 0)
    return [(column, float(x)) for column, x in zip(columns, used, strict=True) if x > 0]


def fill(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[Pattern, int]]:
    """Sequences for the pieces that rounding left: the largest piece, then the fullest subset sum."""
    left = left.copy()
    out: list[tuple[Pattern, int]] = []
    mask = (1 << (room + 1)) - 1
    while left.any():
        pattern: Counter = Counter()
        largest = int(np.flatnonzero(left)[-1])
        pattern[largest] += 1
        space = room - int(sizes[largest])
        reach, steps = 1, []
        for i in np.flatnonzero(left)[::-1]:
            size = int(sizes[i])
            for _ in range(min(int(left[i]) - (i == largest), space // size)):
                steps.append((int(i), size, reach))
                reach |= (reach << size) & mask
                if reach >> space & 1:
                    break
            if reach >> space & 1:
                break
        total = (reach & ((1 << (space + 1)) - 1)).bit_length() - 1
        for i, size, before in reversed(steps):
            if not before >> total & 1:
                pattern[i] += 1
                total -= size
        times = min(int(left[i]) // n for i, n in pattern.items())
        for i, n in pattern.items():
            left[i] -= n * times
        out.append((dict(pattern), times))
    return out


def solve(histogram: dict[int, int], room: int, gap: float = GAP) -> list[tuple[Pattern, int]]:
    """Patterns (pieces per size) and whole counts that cover the histogram exactly."""
    whole = [({room: 1}, histogram[room])] if histogram.get(room) else []
    sizes = np.array(sorted(s for s, n in histogram.items() if s < room and n), np.int64)
    if not len(sizes):
        return whole
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    plan = [
        (pattern, int(x + 1e-9))
        for pattern, x in generate_columns(sizes, demand.astype(float), room, gap)
    ]
    left = demand.copy()
    rounded = []
    for pattern, times in plan:
        times = min([times, *(int(left[i]) // n for i, n in pattern.items())])
        if times > 0:
            rounded.append((pattern, times))
            for i, n in pattern.items():
                left[i] -= n * times
    rounded += fill(sizes, left, room)
    return whole + [({int(sizes[i]): n for i, n in p.items()}, times) for p, times in rounded]


# --- assignment ---------------------------------------------------------------------------------


def assign(sized: DataFrame, capacity: int = CAPACITY, quantum: int = QUANTUM) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces with a `length` of 1 to `capacity`.

    Every piece lies in one sequence; the pieces of a sequence follow each other without gaps. The
    input is read twice and should be stored. Needs the columns `doc_id` and `start` for the order.
    """
    room = capacity // quantum
    step = F.ceil(F.col("length") / quantum).cast("int")
    histogram = sized.groupBy(step.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {row["size"]: row["n"] for row in histogram}
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter = Counter()
    first = 0
    for pattern, times in solve(counts, room):
        for size, per_sequence in pattern.items():
            ranges.setdefault(size, []).append((taken[size], first, per_sequence))
            taken[size] += per_sequence * times
        first += times
    lookup = {size: np.array(rows, np.int64).T for size, rows in ranges.items()}

    @F.pandas_udf(T.LongType())
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.Series:
        out = np.empty(len(sizes), np.int64)
        values, each = sizes.to_numpy(), ranks.to_numpy()
        for size in np.unique(values):
            here = values == size
            starts, firsts, per_sequence = lookup[int(size)]
            i = np.searchsorted(starts, each[here], side="right") - 1
            out[here] = firsts[i] + (each[here] - starts[i]) // per_sequence[i]
        return pd.Series(out)

    in_order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked(sized.withColumn("_size", step), ["_size"], ["doc_id", "start"], "_rank")
        .withColumn("sequence_id", place("_size", "_rank"))
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .drop("_size", "_rank")
    )


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, portion: int = SPLIT_BYTES
) -> DataFrame:
    """Where every piece of every document lies.

    Returns `doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset`. The ids themselves
    are those of `pieces`, by `doc_id` and `start`. Null and empty texts are one piece of one id;
    repeated rows and rows without a `doc_id` are packed like others; an empty table gives no rows.
    Tasks split texts in portions of so many bytes: smaller ones take less memory and more time, with the
    same result. Other columns are ignored.
    """
    sized = pieces(docs, path, capacity, with_ids=False, portion=portion)
    return assign(staged(sized, "pieces"), capacity)
