"""A corpus for training: toxic texts and texts without a language go, of copies and near copies one
stays, and the rest is packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import exact_dedup, language, near_dup, packing, toxicity
from faultline.llm.common import keep_rows, new_prefix, read_table, staged
from faultline.llm.queries import WORD_BPE
from faultline.session import arrow_batches

# The executors still hold what the stages before took, so texts go to Python in batches of few rows,
# and are labelled and packed in small portions.
BATCH_ROWS = 250
PORTION_BYTES = 1_000_000

# A text is in no language if its own has a smaller share of its letters than this.
LEAST_SHARE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is below one half."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    prefix = new_prefix(docs, "_toxic_")
    scored = model.score(docs, prefix)
    return scored.filter(F.col(f"{prefix}score") < 0.5).select(*docs.columns)


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with letters, most of them in spans of one language."""
    prefix = new_prefix(docs, "_language_")
    known = F.col(f"{prefix}lang_pred") != language.UNKNOWN
    known &= F.col(f"{prefix}score") >= LEAST_SHARE
    with arrow_batches(spark, BATCH_ROWS):
        model = language.fit(docs, portion=PORTION_BYTES)
        found = language.predict(docs, model, prefix, portion=PORTION_BYTES)
        return staged(found.filter(known).select(*docs.columns), "known")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    kept = exact_dedup.deduplicate(docs).filter("kept").select("doc_id", "text_sha256")
    return keep_rows(docs, kept, exact_dedup.content_digest(F.col("text")), "text_sha256")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies."""
    with arrow_batches(spark, BATCH_ROWS):
        return near_dup.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with arrow_batches(spark, BATCH_ROWS):
        return packing.pack(docs, WORD_BPE, portion=PORTION_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

# Learned models and sketches are part of it: held against brute force in the tests instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each result is stored before the next stage reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
