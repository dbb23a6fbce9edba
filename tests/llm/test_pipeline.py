"""The pipeline against its stages applied one by one, and the queries against SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from faultline.llm import exact_dedup, language, near_dup
from faultline.llm.oracles import ORACLES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = contract.queries()[name](spark, sf_dir)
    result = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = Counter(result.fetchall())
    assert Counter(map(tuple, df.select(columns).collect())) == expected


def test_stages(spark, sf_dir):
    before = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == before.columns
        docs = after.checkpoint() if spark.sparkContext.getCheckpointDir() else after
        assert docs.exceptAll(before).isEmpty(), name
        if name == "exact_dedup":
            assert exact_dedup.deduplicate(docs).filter("group_size > 1").isEmpty()
    assert near_dup.near_duplicates(docs).filter("NOT kept").isEmpty()
    packed = corpus_pipeline.run(spark, sf_dir)
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


INNER = [
    "_hits", "_vector", "_raw", "_probability", "_prediction", "_toxic_score", "_lang_pred", "_score",
    "_language_score", "_content", "_id", "_wanted", "_row", "row", "id", "content", "set", "bands", "digest",
]


def test_stages_leave_columns_of_any_name_as_they_are(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = table.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in INNER})
    docs = docs.withColumn("big", F.when(F.col("doc_id") % 3 > 0, 2**62 + F.col("doc_id")))
    before = {r.doc_id: r for r in docs.collect()}
    plain = table
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = stage(spark, docs, sf_dir), stage(spark, plain, sf_dir)
        assert docs.columns == [*table.columns, *INNER, "big"]
        docs, plain = docs.checkpoint(), plain.checkpoint()
        rows = docs.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())
        assert all(r == before[r.doc_id] for r in rows)


def near_rows(n, doc_id):
    """Two long texts with `n` near copies each, and `n` texts of their own."""
    base = [" ".join(f"{k}word{i}" for i in range(120)) for k in "ab"]
    rows = [(doc_id(3 * i + j), f"{b} tail{i}") for i in range(n) for j, b in enumerate(base)]
    return rows + [(doc_id(3 * i + 2), " ".join(f"own{i}x{k}" for k in range(20))) for i in range(n)]


@pytest.mark.parametrize("ids", ["none", "repeated", "unique"])
def test_one_near_copy_stays_whatever_the_identifiers(spark, sf_dir, ids):
    doc_id = {"none": lambda i: None, "repeated": lambda i: i % 5, "unique": lambda i: i}[ids]
    rows = near_rows(1000, doc_id) + [(doc_id(1), None), (doc_id(1), " ")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, at int")
    kept = corpus_pipeline.drop_near_copies(spark, docs.repartition(6), sf_dir).collect()
    assert {(r.doc_id, r.text) for r in kept} <= {(d, t) for d, t in rows}
    texts = [r.text or "" for r in kept]
    assert sum(t.startswith("aword") for t in texts) == sum(t.startswith("bword") for t in texts) == 1
    assert sum(t.startswith("own") for t in texts) == 1000 and len(kept) == 1004


@pytest.mark.parametrize(
    ("stage", "operator"),
    [
        ("drop_unknown_languages", "language.predict"),
        ("drop_near_copies", "near_dup.deduplicated"),
        ("pack", "packing.pack"),
    ],
)
def test_texts_go_to_python_in_batches_of_few_rows(spark, sf_dir, monkeypatch, stage, operator):
    most = corpus_pipeline.BATCH_ROWS
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def small(batches):
        for batch in batches:
            if batch.num_rows <= most:
                yield batch

    def stand_in(docs, model=None, prefix="", portion=None):
        found = docs.mapInArrow(small, docs.schema)
        if operator != "language.predict":
            return found.localCheckpoint()
        return found.withColumns({f"{prefix}lang_pred": F.lit("en"), f"{prefix}score": F.lit(1.0)})

    monkeypatch.setattr(f"faultline.llm.{operator}", stand_in)
    rows = 3 * most + 1
    docs = spark.range(0, rows, 1, 1).selectExpr("id AS doc_id", "'some words' AS text", "'en' AS lang")
    assert getattr(corpus_pipeline, stage)(spark, docs, sf_dir).count() == rows
    assert spark.conf.get(name) == before


def test_portions_do_not_change_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200).localCheckpoint()
    few, many = language.fit(docs), language.fit(docs, portion=5_000)
    assert few.languages == many.languages
    assert (few.weights == many.weights).all() and (few.writes == many.writes).all()
    whole = language.predict(docs, few, spans=True).select("doc_id", "lang_pred", "score", "spans")
    cut = language.predict(docs, few, spans=True, portion=5_000).select(*whole.columns)
    assert Counter(map(str, whole.collect())) == Counter(map(str, cut.collect()))
