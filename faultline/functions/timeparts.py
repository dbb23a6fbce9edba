"""Durations and window columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """Seconds in a duration such as `5 minutes` or `1 hour`."""
    amount, unit = text.split()
    return int(amount) * UNIT_SECONDS[unit.lower().removesuffix("s")]


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the `window` struct by the columns `window_start` and `window_end`."""
    others = [name for name in df.columns if name != "window"]
    return df.selectExpr(
        "window.start AS window_start", "window.end AS window_end", *(f"`{name}`" for name in others)
    )
