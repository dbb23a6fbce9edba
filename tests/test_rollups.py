from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faultline.functions.timeparts import duration_seconds
from faultline.operators import peaks, rollups
from faultline.operators.thresholds import magnitude_threshold
from faultline.plans.inputs import event_readings
from faultline.schemas import READINGS_TABLE
from helpers import collect, readings


def test_tumbling_boundary(spark):
    df = readings(spark, [(899, "a", True, 1.0, 1.0), (900, "a", False, 3.0, 1.2)])
    rows = rollups.window_stats(df, "15 minutes").orderBy("window").collect()
    assert [r["nombre_observations"] for r in rows] == [1, 1]
    assert [r["nombre_secousses"] for r in rows] == [1, 0]


def test_one_reading_is_in_five_sliding_windows(spark):
    df = readings(spark, [(30, "a", True, 1.0, 1.0)])
    assert rollups.window_stats(df, "5 minutes", "1 minute").count() == 5


@pytest.mark.parametrize("width", ["1 hour", "15 minutes"])
def test_windows_hold_every_timed_reading(spark, sf_dir, width):
    df = event_readings(spark, sf_dir)
    total = rollups.window_stats(df, width).agg(F.sum("nombre_observations")).first()[0]
    assert total == df.filter("date IS NOT NULL").count()


def test_an_hour_is_its_four_quarters(spark, sf_dir):
    df = event_readings(spark, sf_dir)
    quarters = rollups.window_stats(df, "15 minutes").groupBy(
        F.date_trunc("hour", "window.start").alias("h")
    ).agg(F.sum("nombre_secousses").alias("n"), F.max("magnitude_max").alias("m"))
    hours = rollups.window_stats(df, "1 hour").select(
        F.date_trunc("hour", "window.start").alias("h"),
        F.col("nombre_secousses").alias("n"),
        F.col("magnitude_max").alias("m"),
    )
    assert collect(quarters, "h") == collect(hours, "h")


def test_unknown_flags_are_not_counted(spark):
    df = readings(spark, [(0, "a", None, 1.0, 1.0), (1, "a", True, 1.0, 1.0)])
    assert collect(rollups.flag_counts(df, "ville")) == [("a", 1)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], READINGS_TABLE).withColumn("date", F.col("date").cast("timestamp"))
    threshold = magnitude_threshold(empty)
    assert collect(threshold) == [(None,)]
    assert peaks.activity_peaks(empty, threshold).count() == 0
    assert rollups.hourly_stats(empty).count() == 0
    assert collect(rollups.mean_above(empty)) == [(None,)]


def test_top_windows_break_ties_by_time(spark):
    df = readings(spark, [(t, e, True, 5.0, 1.0) for t in (0, 900, 1800) for e in "ab"])
    stats = rollups.window_stats(df, "15 minutes", entity="ville")
    top = peaks.top_windows(stats, 2, "nombre_observations")
    assert [(r["window"]["start"].minute, r["ville"]) for r in top.collect()] == [(0, "a"), (0, "b")]
    per_entity = peaks.top_windows(stats, 1, "nombre_observations", "ville")
    assert {(r["window"]["start"].minute, r["ville"]) for r in per_entity.collect()} == {(0, "a"), (0, "b")}


def test_extremes_take_the_earliest_hour(spark):
    df = readings(spark, [(h * 3600, "a", True, 1.0, x) for h, x in enumerate([1.2, 1.4, 1.4, 1.2])])
    row = peaks.extremes(rollups.hour_profile(df)).first()
    assert (row["heure_max"], row["heure_min"]) == (1, 0)


def test_durations():
    assert [duration_seconds(d) for d in ("5 minutes", "1 hour", "30 seconds")] == [300, 3600, 30]
