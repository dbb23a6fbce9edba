"""The operators of this folder over their whole tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import (
    bpe,
    exact_dedup,
    language,
    licenses,
    line_dedup,
    near_dup,
    packing,
    periodic,
    quality,
    resampling,
    sharding,
    toxicity,
    urls,
)
from faultline.llm.common import read_table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the document it was rendered from, whose number ends its path."""
    pages = read_table(spark, sf_dir, "pages")
    labels = read_table(spark, sf_dir, "labels")
    _, path = urls.host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"^/[^/]*/([0-9]+)", 1).try_cast("long")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labelled = pages.select("url", number.alias("doc_id")).join(labels, "doc_id")
    return urls.judge(pages, labelled.select("url", bad.alias("block")))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read_table(spark, sf_dir, "documents"))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read_table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return toxicity.judge(read_table(spark, sf_dir, "documents"), labels)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), RANKS, PATTERN)


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document has runs planted first, as the contract of this query asks."""
    docs = periodic.with_planted_runs(read_table(spark, sf_dir, "documents"))
    found = periodic.collapse_runs(docs).withColumn("top", periodic.longest_run(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"top.{name}").alias(name) for name in ("start", "length", "period")),
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(periodic.run_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.col("text"), 256).alias("collapsed_sha256"),
    )


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_shared_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    return resampling.resample(read_table(spark, sf_dir, "documents"), benchmark)
