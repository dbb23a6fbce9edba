"""Quality rules: base rules per document, and lines that too many documents of a host repeat.

Lines are normalised and hashed, and the distinct documents that hold a line are counted per host.
Copies of one text count as one document, so that a text is not taken for boilerplate because it was
stored twice. Lines beyond a number of documents are removed, whatever the size of their host; lines of
few words have a higher limit. Documents that lose too much are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import BLANKS, NOT_BLANKS, ascii_lower, words

SYMBOLS = "#*$%&|<>"

# Base rules: fewer words, or a larger percentage of words in repeated windows, fail.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

# A line goes if more than this many documents of its host hold it; one of fewer than `LONG_LINE` words,
# which authors may write alike by chance, beyond a higher limit.
LINE_DOCUMENTS = 10
SHORT_LINE_DOCUMENTS = 20
LONG_LINE = 5
# A document is depleted if its lines keep a smaller share of their words, or too few words.
KEPT_SHARE = 0.3


def base_metrics(docs: DataFrame) -> DataFrame:
    """Add `n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words` from the column `text`.

    `n_repeat_words` counts the words in windows of five words that the text holds more than once.
    Windows are compared by 64-bit hashes: sorted by hash, repeats stand side by side, and in order
    of position each repeat covers up to the next one. Texts whose windows all differ skip the sort.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<hash:bigint,at:int>>")
    nowhere = F.array().cast("array<int>")
    starts = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    windows = F.transform(
        starts, lambda i: F.xxhash64(*(F.get(F.col("_hashes"), i + k) for k in range(WINDOW)))
    )
    alike = F.size(F.array_distinct("_windows")) < F.size("_windows")
    by_hash = F.array_sort(
        F.transform("_windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )

    def repeats(x: Column, i: Column) -> Column:
        before, after = F.get(F.col("_sorted"), i - 1), F.get(F.col("_sorted"), i + 1)
        return x["hash"].eqNullSafe(before["hash"]) | x["hash"].eqNullSafe(after["hash"])

    def covers(at: Column, i: Column) -> Column:
        following = F.coalesce(F.get(F.col("_repeats"), i + 1), at + WINDOW)
        return F.least(F.lit(WINDOW), following - at)

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANKS))
    return (
        docs.withColumn("_words", words(F.col("text")))
        .withColumn("_lines", lines)
        .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn(
            "_windows",
            F.when(F.size("_words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")),
        )
        .withColumn("_sorted", F.when(alike, by_hash).otherwise(none))
        .withColumn(
            "_repeats",
            F.when(
                F.size("_sorted") > 0,
                F.array_sort(F.transform(F.filter("_sorted", repeats), lambda x: x["at"])),
            ).otherwise(nowhere),
        )
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.regexp_replace(text, BLANKS, "")).cast("long"),
                "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.aggregate(
                    F.transform("_repeats", covers), F.lit(0).cast("long"), lambda a, x: a + x
                ),
            }
        )
        .drop("_words", "_lines", "_hashes", "_windows", "_sorted", "_repeats")
    )


def normalised_lines(text: Column) -> Column:
    """The distinct lines of a text that hold a word, as structs of hash and number of words.

    Lines are equal when they differ only in A-Z case, blanks at their ends or in a row, or digits.
    """

    def shape(line: Column) -> Column:
        spaced = F.trim(F.regexp_replace(line, BLANKS, " "))
        return F.translate(ascii_lower(spaced), "123456789", "000000000")

    shapes = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), shape)
    held = F.array_distinct(F.filter(shapes, lambda line: line != ""))
    blanks = lambda line: F.length(line) - F.length(F.replace(line, F.lit(" ")))
    return F.transform(
        held,
        lambda line: F.struct(
            F.xxhash64(line).alias("line"), (blanks(line) + 1).cast("long").alias("words")
        ),
    )


def repeated_lines(
    docs: DataFrame,
    host: str,
    documents: int = LINE_DOCUMENTS,
    short_documents: int = SHORT_LINE_DOCUMENTS,
) -> DataFrame:
    """Per host and distinct text: words in its distinct lines, and those in lines beyond the limits.

    Returns `_host, _text, line_words, removed_words`. A null host is a host of its own.
    """
    texts = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("_host"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_text"),
        F.explode(normalised_lines(F.col("text"))).alias("_line"),
    )
    # One row per host, text and line: copies of a text meet before the shuffle where they can.
    rows = texts.select("_host", "_text", "_line.line", "_line.words").distinct()
    common = (
        rows.groupBy("_host", "line")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("words").alias("_words"))
        .filter(
            F.col("_n") > F.when(F.col("_words") >= LONG_LINE, documents).otherwise(short_documents)
        )
        .select("_host", "line", F.lit(True).alias("_common"))
    )
    return (
        rows.join(common, ["_host", "line"], "left")
        .groupBy("_host", "_text")
        .agg(
            F.sum("words").alias("line_words"),
            F.coalesce(F.sum(F.when(F.col("_common"), F.col("words"))), F.lit(0)).alias(
                "removed_words"
            ),
        )
    )


def judge(
    docs: DataFrame,
    host: str = "source",
    documents: int = LINE_DOCUMENTS,
    short_documents: int = SHORT_LINE_DOCUMENTS,
    kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """Base metrics and the verdict of every document, one row per input row.

    Returns `doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    line_words, removed_words`. A null or empty text has no words and fails. Rows that repeat get the
    same verdict, whatever their `doc_id`; ties do not occur, as every limit is a strict count.
    Other columns of `docs` are ignored.
    """
    rows = docs.select("doc_id", "text", F.col(host).alias("host"))
    key = F.coalesce(F.concat(F.lit("="), F.col("host").cast("string")), F.lit(""))
    measured = base_metrics(
        rows.withColumns(
            {"_host": key, "_text": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))}
        )
    ).drop("text", "host")
    lines = repeated_lines(rows, "host", documents, short_documents)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    left = F.col("line_words") - F.col("removed_words")
    depleted = (left < LEAST_WORDS) | (left < F.lit(kept_share) * F.col("line_words"))
    # A document that lost no line is not depleted, however few words its lines have.
    return (
        measured.join(lines, ["_host", "_text"], "left")
        .fillna(0, ["line_words", "removed_words"])
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~((F.col("removed_words") > 0) & depleted))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "kept",
            "line_words",
            "removed_words",
        )
    )
