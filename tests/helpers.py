"""Small inline tables of readings."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)
READING = "event_id long, date timestamp_ntz, ville string, secousse boolean, magnitude double, tension_entre_plaque double"


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def readings(spark, rows):
    """Rows of (seconds, entity, flag, value, stress); the position is the key."""
    data = [(i, at(t), e, f, m, x) for i, (t, e, f, m, x) in enumerate(rows)]
    return spark.createDataFrame(data, READING)


def collect(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
