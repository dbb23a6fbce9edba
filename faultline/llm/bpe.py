"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are cut into pre-tokens. Each portion of texts lists its distinct pre-tokens, and keeps its
   texts as positions in that list: a frequent pre-token counts once per portion.
2. The lists are divided by a hash of the pre-token and shuffled, so that equal pre-tokens meet in one
   task, which encodes each distinct one once. Beyond `BLOCK_PORTIONS` portions they meet by block of
   portions, so that the work of a task, and what it remembers, do not grow with the corpus.
3. The ids go back to their portions, where the texts are put together again by position.

Decoding looks every id up in an array of token bytes (as many as the vocabulary has), in the task that
puts the ids together; no join is made for it.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import gather, offsets_of, release_memory, staged

# Bytes of texts that share one list of distinct pre-tokens, and of those that are cut at a time: the
# lists get shorter with larger portions, while the memory that cutting takes depends on the cuts.
PORTION_BYTES = 16_000_000
CUT_BYTES = 2_000_000

# Pre-tokens are divided for the shuffle by a hash, and portions by another into blocks of about so many
# (1 GB of texts); the distinct pre-tokens of a division and block are remembered together.
DIVISIONS = 128
BLOCK_PORTIONS = 64
# So many distinct pre-tokens of one are remembered at a time; more are looked up afresh.
MOST_KNOWN = 500_000
# Ranks that take one byte, and the byte that stands for the next pre-token that occurs only once.
FREQUENT = 200
ONCE = 255

# A single space between two other characters always starts a pre-token, so texts are cut there
# first. Texts with other runs of white space go through the pattern as a whole.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUNS = f"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$"

# Marks that follow words often.
ENDINGS = ".,;:!?"


@functools.cache
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _token_bytes(path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    ranks = _encoding(path, pattern)._mergeable_ranks
    tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        tokens[number] = token
    return offsets_of(map(len, tokens)), np.frombuffer(b"".join(tokens), np.uint8)


def cut(texts: pa.Array, pattern: str) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct pre-tokens of the texts, and each text as positions in that list."""
    find = regex.compile(pattern).findall
    whole = pc.match_substring_regex(texts, _RUNS)
    parted = pc.split_pattern(pc.if_else(whole, pa.scalar(None, texts.type), texts), " ")
    coded = parted.flatten().dictionary_encode()
    parts = coded.dictionary
    # Letters with marks after them are two pre-tokens, in any pattern that keeps letters together.
    letters = pc.utf8_rtrim(parts, ENDINGS)
    plain = pc.utf8_is_alpha(letters).to_pylist()
    sizes = pc.utf8_length(letters).to_pylist()
    counts, found = [], []
    for part, size, is_plain in zip(parts.to_pylist(), sizes, plain, strict=True):
        if not is_plain:
            tokens = find(" " + part)
            counts.append(len(tokens))
            found += tokens
        elif size == len(part):
            counts.append(1)
            found.append(" " + part)
        else:
            counts.append(2)
            found += (" " + part[:size], part[size:])
    # The first part of a text has no space before it, so it is a chunk of its own.
    known = len(counts)
    for chunk in pc.if_else(whole, texts, pc.list_element(parted, 0)).to_pylist():
        tokens = find(chunk)
        counts.append(len(tokens))
        found += tokens
    tokens = pa.array(found, pa.large_string()).dictionary_encode()
    offsets, flat = offsets_of(counts), tokens.indices.to_numpy()
    codes = coded.indices.to_numpy()
    ends = parted.offsets.to_numpy() - parted.offsets[0].as_py()
    lines = []
    for i in range(len(texts)):
        rest = codes[ends[i] + 1 : ends[i + 1]]
        lines.append(gather(offsets, flat, np.concatenate(([known + i], rest))))
    return tokens.dictionary, lines


def _slices(
    batches: Iterable[pa.RecordBatch], most: int
) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Identifiers and texts in parts of at most `most` bytes of text (or one text)."""
    for batch in batches:
        texts = pc.fill_null(batch["text"].cast(pa.large_string()), "")
        start, total = 0, 0
        for i, size in enumerate([*pc.binary_length(texts).to_pylist(), most + 1]):
            if i > start and total + size > most:
                # Rows are taken rather than sliced: string kernels misread the offsets of slices.
                rows = pa.array(np.arange(start, i))
                yield batch["doc_id"].take(rows), texts.take(rows)
                start, total = i, 0
            total += size


def _portions(
    batches: Iterable[pa.RecordBatch], pattern: str
) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """Portions of texts: their identifiers, distinct pre-tokens, number of pre-tokens of each text,
    and the pre-tokens of all texts as positions in the distinct ones."""
    held: list[tuple[pa.Array, pa.DictionaryArray, list[int]]] = []
    total = 0

    def joined() -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
        ids = pa.concat_arrays([x for x, _, _ in held])
        coded = pa.chunked_array([x for _, x, _ in held]).unify_dictionaries()
        numbers = np.concatenate([x.indices.to_numpy() for x in coded.chunks])
        sizes = np.asarray([n for _, _, counts in held for n in counts], np.int64)
        return ids, coded.chunk(0).dictionary, sizes, numbers

    for ids, texts in _slices(batches, CUT_BYTES):
        words, lines = cut(texts, pattern)
        numbers = pa.array(np.concatenate(lines).astype(np.int32))
        size = pc.sum(pc.binary_length(texts)).as_py()
        if held and total + size > PORTION_BYTES:
            yield joined()
            held, total = [], 0
        held.append((ids, pa.DictionaryArray.from_arrays(numbers, words), [len(x) for x in lines]))
        total += size
    if held:
        yield joined()


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], held[ends[0] : ends[-1]]


def _pack(sizes: np.ndarray, data: bytes) -> bytes:
    """Items one after the other, compressed: their number, their sizes, and their bytes."""
    head = np.asarray([len(sizes)], "<u4").tobytes() + sizes.astype("<u4").tobytes()
    return zstandard.ZstdCompressor(level=9).compress(head + data)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    end = 4 + 4 * int(np.frombuffer(raw, "<u4", 1)[0])
    return np.frombuffer(raw[4:end], "<u4").astype(np.int64), raw[end:]


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte: first all lowest bytes, and so on. Compresses better."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _pack_ranks(sizes: np.ndarray, numbers: np.ndarray, repeated: int) -> bytes:
    """Texts as ranks of their pre-tokens by frequency: one byte for the most frequent, and two more,
    kept apart, for the others. The ranks from `repeated` on occur once each, in this order, so one
    byte says it all. Where three bytes can't hold the ranks, as planes."""
    if repeated > FREQUENT + (ONCE - FREQUENT) * 65536:
        data = _planes(numbers)
    else:
        once = numbers >= repeated
        rare = (numbers >= FREQUENT) & ~once
        over = numbers[rare] - FREQUENT
        lead = np.minimum(numbers, ONCE).astype(np.uint8)
        lead[rare] = FREQUENT + (over >> 16)
        lead[once] = ONCE
        rest = np.concatenate((over & 255, over >> 8 & 255)).astype(np.uint8)
        data = lead.tobytes() + rest.tobytes()
    return _pack(np.concatenate(([repeated], sizes)), data)


def _unpack_ranks(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes, data = _unpack(blob)
    repeated, sizes = sizes[0], sizes[1:]
    total = int(sizes.sum())
    if total and len(data) == 4 * total:
        return sizes, _from_planes(data).astype(np.int64)
    ranks = np.frombuffer(data[:total], np.uint8).astype(np.int64)
    low, high = np.frombuffer(data[total:], np.uint8).astype(np.int64).reshape(2, -1)
    once = ranks == ONCE
    rare = (ranks >= FREQUENT) & ~once
    ranks[rare] = FREQUENT + (ranks[rare] - FREQUENT << 16) + (high << 8) + low
    ranks[once] = repeated + np.arange(np.count_nonzero(once))
    return sizes, ranks


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """The token ids of every text: `doc_id, ids`, with ids as little-endian unsigned 32-bit numbers.

    One row per input row, repeated rows and null `doc_id` included. Null and empty texts give empty
    ids. `path` is a file of ranks that all executors can open. Other columns are ignored. With
    `decoded`, the ids are decoded as `decode` does, in the task that put them together.
    """
    key = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("portion", T.LongType()),
            T.StructField("division", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(key)),
            T.StructField("data", T.BinaryType()),
            T.StructField("divisions", T.BinaryType()),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per portion with its texts, and the division of each word; and one row per portion
        and division with its words."""
        portion = TaskContext.get().partitionId() << 32
        for ids, words, sizes, numbers in _portions(batches, pattern):
            times = np.bincount(numbers, minlength=len(words))
            first = np.zeros(len(words), np.int32)
            first[numbers[::-1]] = np.arange(len(numbers) - 1, -1, -1, dtype=np.int32)
            by_rank = np.lexsort((first, -times))
            ranks = np.empty(len(words), np.int32)
            ranks[by_rank] = np.arange(len(words))
            coded = _pack_ranks(sizes, ranks[numbers], int(np.count_nonzero(times > 1)))
            words = words.take(pa.array(by_rank))
            division = np.fromiter(
                (zlib.crc32(w.encode()) % DIVISIONS for w in words.to_pylist()), np.uint8, len(words)
            )
            order = np.argsort(division, kind="stable")
            offsets, data = _bytes(words.cast(pa.large_binary()).take(pa.array(order)))
            held = data.tobytes()
            bounds = np.searchsorted(division[order], np.arange(DIVISIONS + 1))
            lists = [
                _pack(np.diff(offsets[a : b + 1]), held[offsets[a] : offsets[b]])
                for a, b in zip(bounds, bounds[1:], strict=False)
                if b > a
            ]
            present = np.flatnonzero(np.diff(bounds)).tolist()
            doc_ids = pa.ListArray.from_arrays([0, *[len(ids)] * (len(lists) + 1)], ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "portion": pa.repeat(portion, len(lists) + 1),
                    "division": pa.array([None, *present], pa.int32()),
                    "doc_ids": doc_ids,
                    "data": pa.array([coded, *lists], pa.binary()),
                    "divisions": pa.array(
                        [_pack(np.zeros(0), division.tobytes()), *[None] * len(lists)], pa.binary()
                    ),
                }
            )
            portion += 1
        # What cutting took must not stay with the worker while words are encoded.
        release_memory()

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lists of a division and block follow each other, so only its words are remembered."""
        ordinary = _encoding(path, pattern).encode_ordinary
        known: dict[bytes, bytes] = {}
        last = None
        for batch in batches:
            out = []
            for division, block, blob in zip(
                *(batch[name].to_pylist() for name in ("division", "block", "data")), strict=True
            ):
                if (division, block) != last or len(known) > MOST_KNOWN:
                    last, known = (division, block), {}
                sizes, data = _unpack(blob)
                ends = offsets_of(sizes).tolist()
                found = []
                for start, end in zip(ends, ends[1:], strict=False):
                    word = data[start:end]
                    ids = known.get(word)
                    if ids is None:
                        ids = np.asarray(ordinary(word.decode()), "<u4").tobytes()
                        known[word] = ids
                    found.append(ids)
                flat = np.frombuffer(b"".join(found), "<u4")
                numbers = np.fromiter(map(len, found), np.int64, len(found)) // 4
                out.append(_pack(numbers, _planes(flat)))
            yield pa.RecordBatch.from_pydict(
                {
                    "portion": batch["portion"],
                    "division": batch["division"],
                    "ids": pa.array(out, pa.binary()),
                }
            )

    def assemble(texts: pa.Table, words: pa.Table) -> pa.Table:
        division = _unpack(texts["divisions"][0].as_py())[1]
        order = np.argsort(np.frombuffer(division, np.uint8), kind="stable")
        # The place of each rank among the returned lists, which come by division.
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lists = [_unpack(x) for x in words.sort_by("division")["ids"].to_pylist()]
        sizes = np.concatenate([np.zeros(0, np.int64), *(sizes for sizes, _ in lists)])
        flat = np.concatenate([np.zeros(0, "<u4"), *(_from_planes(data) for _, data in lists)])
        offsets = offsets_of(sizes)
        lengths, ranks = _unpack_ranks(texts["data"][0].as_py())
        ends = offsets_of(lengths)
        out = [
            gather(offsets, flat, place[ranks[a:b]]).tobytes()
            for a, b in zip(ends, ends[1:], strict=False)
        ]
        columns = {
            "doc_id": texts["doc_ids"].combine_chunks().flatten(),
            "ids": pa.array(out, pa.binary()),
        }
        if decoded:
            columns["decoded"] = _decoded(out, path, pattern)
        return pa.table(columns)

    parts = staged(docs.select("doc_id", "text").mapInArrow(split, schema), "bpe")
    blocks = 1 + parts.filter("division IS NULL").count() // BLOCK_PORTIONS
    words = (
        parts.filter("division IS NOT NULL")
        .withColumn("block", F.pmod(F.xxhash64("portion"), F.lit(blocks)))
        .select("division", "block", "portion", "data")
        .repartition("division", "block")
        .sortWithinPartitions("division", "block")
        .mapInArrow(encode_words, "portion long, division int, ids binary")
    )
    texts = parts.filter("division IS NULL").select("portion", "doc_ids", "data", "divisions")
    names = ["ids", "decoded"] if decoded else ["ids"]
    fields = [T.StructField("doc_id", key), *(T.StructField(x, T.BinaryType()) for x in names)]
    result = T.StructType(fields)
    return texts.groupBy("portion").cogroup(words.groupBy("portion")).applyInArrow(assemble, result)


def _decoded(column: Iterable[bytes | None], path: str, pattern: str) -> pa.Array:
    """The bytes of each item's ids, from the table of token bytes."""
    offsets, flat = _token_bytes(path, pattern)
    found = (
        None
        if ids is None
        else gather(offsets, flat, np.frombuffer(ids, "<u4").astype(np.int64)).tobytes()
        for ids in column
    )
    return pa.array(found, pa.binary())


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add `decoded`, the bytes of the column `ids`; null ids give null bytes."""
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _decoded(batch["ids"].to_pylist(), path, pattern)
            yield batch.append_column("decoded", found)

    return tokens.mapInArrow(look_up, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of tokens, digest of the ids, and digest of the decoded bytes of every text."""
    coded = encode(docs, path, pattern, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
