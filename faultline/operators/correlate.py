"""Descriptions and correlations of numeric columns, overall or per entity."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.stats import for_each, pearson
from faultline.operators.precursors import SEQUENCE_COLUMNS

# Figures that need a row.
NO_FIGURES = ["moyenne", "ecart_type", "minimum", "maximum"]


def describe_columns(
    df: DataFrame,
    columns: Sequence[str] = SEQUENCE_COLUMNS,
    entity: str | None = None,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum: one row per column (and entity).

    Entities of `entities` without a row in `df` have a count of 0.
    """
    keys = [entity] if entity else []
    figures = [
        F.struct(
            F.lit(name).alias("colonne"),
            F.count(name).alias("nombre"),
            F.avg(name).alias("moyenne"),
            F.stddev(name).alias("ecart_type"),
            F.min(name).cast("double").alias("minimum"),
            F.max(name).cast("double").alias("maximum"),
        )
        for name in columns
    ]
    found = df.groupBy(*keys).agg(F.array(*figures).alias("figures"))
    none = [
        F.struct(
            F.lit(name).alias("colonne"),
            F.lit(0).cast("long").alias("nombre"),
            *(F.lit(None).cast("double").alias(x) for x in NO_FIGURES),
        )
        for name in columns
    ]
    every = F.coalesce("figures", F.array(*none))
    return for_each(entities, found, entity).select(*keys, F.inline(every))


def correlation_pairs(
    df: DataFrame,
    columns: Sequence[str] = SEQUENCE_COLUMNS,
    entity: str | None = None,
    min_abs: float | None = 0.3,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Pearson correlation of every pair of columns, in one aggregation of `df`.

    Only pairs with an absolute correlation above `min_abs` are kept; all pairs if it is None, then
    also those of `entities` without a row in `df`, as null.
    """
    keys = [entity] if entity else []
    pairs = [
        F.struct(
            F.lit(left).alias("gauche"),
            F.lit(right).alias("droite"),
            pearson(left, right).alias("correlation"),
        )
        for left, right in combinations(sorted(columns), 2)
    ]
    none = [
        F.struct(
            F.lit(left).alias("gauche"),
            F.lit(right).alias("droite"),
            F.lit(None).cast("double").alias("correlation"),
        )
        for left, right in combinations(sorted(columns), 2)
    ]
    found = df.groupBy(*keys).agg(F.array(*pairs).alias("pairs"))
    every = F.coalesce("pairs", F.array(*none))
    matrix = for_each(entities, found, entity).select(*keys, F.inline(every))
    return matrix if min_abs is None else matrix.filter(F.abs("correlation") > min_abs)
