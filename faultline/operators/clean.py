"""Raw text readings to typed, filled readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.coercion import to_flag, to_number, to_time
from faultline.columns import COLUMNS, Columns
from faultline.schemas import RENAMES


def _typed(cols: Columns) -> dict[str, Column]:
    return {
        cols.time: to_time(F.col(cols.time)),
        cols.flag: to_flag(F.col(cols.flag)),
        cols.value: to_number(F.col(cols.value)),
        cols.stress: to_number(F.col(cols.stress)),
    }


def clean_readings(
    df: DataFrame,
    cols: Columns = COLUMNS,
    renames: Mapping[str, str] = RENAMES,
    fill: float | None = 0.0,
) -> DataFrame:
    """Rename, coerce and fill readings; other columns pass through.

    Unreadable values become null. Null and NaN numbers become `fill` (kept when `fill` is None);
    times and flags stay null.
    """
    typed = df.withColumnsRenamed(dict(renames)).withColumns(_typed(cols))
    return typed if fill is None else typed.na.fill(fill, subset=[cols.value, cols.stress])


def rejects(
    df: DataFrame, cols: Columns = COLUMNS, renames: Mapping[str, str] = RENAMES
) -> DataFrame:
    """Raw rows with at least one unreadable field, and the names of those fields in `rejected`."""
    raw = df.withColumnsRenamed(dict(renames))
    unreadable = [
        F.when(F.col(name).isNotNull() & typed.isNull(), F.lit(name))
        for name, typed in _typed(cols).items()
    ]
    return raw.withColumn("rejected", F.array_compact(F.array(*unreadable))).filter(
        F.size("rejected") > 0
    )
