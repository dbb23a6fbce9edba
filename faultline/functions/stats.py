"""Aggregate expressions shared by the batch and streaming operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact(value: str) -> Column:
    """The value as a decimal, null where a decimal does not hold it to the last digit."""
    held = F.col(value).try_cast("decimal(38,18)")
    return F.when(held.cast("double") == F.col(value), held)


def exact_ratio(total: Column, known: Column, rough: Column, count: Column) -> Column:
    """`total / count` from a sum of decimals, so that it does not depend on the order of the rows;
    the sum of doubles, `rough`, where not all values are `known` as decimals."""
    whole = total.isNotNull() & (known == count)
    return ratio(F.when(whole, total.cast("double")).otherwise(rough), count)


def ratio(total: Column, count: Column) -> Column:
    """`total / count`, null where the count is zero."""
    return total / F.nullif(count, F.lit(0))


def pearson(left: str, right: str) -> Column:
    """Pearson correlation over the rows where both columns are present.

    Null for a constant column, a single row or no row, where `corr` fails in ANSI mode.
    """
    both = F.col(left).isNotNull() & F.col(right).isNotNull()
    x, y = F.when(both, F.col(left)), F.when(both, F.col(right))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def for_each(entities: DataFrame | None, found: DataFrame, entity: str | None) -> DataFrame:
    """`found`, with a row of nulls for each of the `entities` that it lacks."""
    if entities is None or entity is None:
        return found
    each = entities.select(F.col(entity).alias("_each")).distinct()
    rest = [name for name in found.columns if name != entity]
    joined = each.join(found, each["_each"].eqNullSafe(found[entity]), "left")
    return joined.select(F.col("_each").alias(entity), *rest)
