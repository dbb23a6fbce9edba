from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faultline.functions.stats import pearson
from faultline.operators.correlate import correlation_pairs, describe_columns
from helpers import collect


def corr(spark, rows):
    return spark.createDataFrame(rows, "x double, y double").agg(pearson("x", "y").alias("r")).first()["r"]


def test_pairs_with_a_gap_are_left_out(spark):
    assert corr(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 1.0)]) == pytest.approx(-0.5)


@pytest.mark.parametrize("rows", [[(1.0, 2.0), (1.0, 4.0)], [(1.0, 2.0)], []])
def test_without_spread_there_is_no_correlation(spark, rows):
    assert corr(spark, rows) is None


def test_pairs_are_filtered_by_strength(spark):
    df = spark.createDataFrame([(i, 2 * i, (i * 7) % 5) for i in range(20)], "a long, b long, c long")
    pairs = correlation_pairs(df, ["a", "b", "c"])
    assert collect(pairs.select("gauche", "droite")) == [("a", "b")]
    assert correlation_pairs(df, ["a", "b", "c"], min_abs=None).count() == 3


def test_matrix_is_one_aggregation(spark):
    df = spark.range(100).select(*(F.rand(i).alias(c) for i, c in enumerate("abcde")))
    plan = correlation_pairs(df, list("abcde"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_description(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("x", None), ("y", 5.0)], "ville string, m double")
    rows = collect(describe_columns(df, ["m"], "ville"), "ville")
    assert rows[0][:4] == ("x", "m", 2, 2.0) and rows[0][5:] == (1.0, 3.0)
    assert rows[0][4] == pytest.approx(2**0.5)
    assert rows[1] == ("y", "m", 1, 5.0, None, 5.0, 5.0)
    assert collect(describe_columns(df.filter("m > 9"), ["m"])) == [("m", 0, None, None, None, None)]


def test_entities_without_a_row_are_kept(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("x", 3.0, 1.0)], "ville string, m double, n double")
    names = spark.createDataFrame([("x",), ("quiet",), (None,), ("quiet",)], "ville string")
    described = describe_columns(df, ["m"], "ville", names)
    assert collect(described.select("ville", "colonne", "nombre", "moyenne"), "ville") == [
        (None, "m", 0, None),
        ("quiet", "m", 0, None),
        ("x", "m", 2, 2.0),
    ]
    pairs = correlation_pairs(df, ["m", "n"], "ville", None, names)
    assert [(r[0], r[1], r[2], r[3] is None) for r in collect(pairs, "ville")] == [
        (None, "m", "n", True),
        ("quiet", "m", "n", True),
        ("x", "m", "n", False),
    ]
    assert collect(correlation_pairs(df, ["m", "n"], "ville", 0.3, names).select("ville")) == [("x",)]
