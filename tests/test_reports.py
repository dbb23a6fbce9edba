from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faultline.operators import peaks, rollups
from faultline.operators.thresholds import magnitude_threshold
from faultline.plans.inputs import event_readings
from faultline.plans.queries import comparable
from faultline.plans.reports import aggregation_report, precursor_report
from faultline.sources.readers import read_parquet
from faultline.sources.sinks import save_tables
from helpers import collect, readings

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def df(spark):
    return event_readings(spark, SMALL)


def test_tables_survive_saving(spark, df, tmp_path):
    report = aggregation_report(df, "ville")
    paths = save_tables(report, str(tmp_path))
    assert list(paths) == [
        "agg_horaire",
        "agg_15min",
        "pics_activite",
        "tendances_tension",
        "agg_ville_heure",
        "periodes_critiques",
    ]
    for name, path in paths.items():
        assert read_parquet(spark, path).count() == report[name].count()


def test_tables_equal_the_single_operators(spark, df):
    late = df.limit(1).withColumn("date", F.lit(None).cast("timestamp_ntz"))
    gaps = df.unionByName(late)
    threshold = magnitude_threshold(gaps)
    direct = {
        "agg_horaire": rollups.hour_profile(gaps),
        "agg_15min": rollups.window_stats(gaps, "15 minutes"),
        "pics_activite": peaks.activity_peaks(gaps, threshold),
        "tendances_tension": rollups.stress_trend(gaps),
        "agg_ville_heure": rollups.hour_profile(gaps, "ville"),
        "periodes_critiques": peaks.critical_periods(gaps, threshold),
    }
    for name, table in aggregation_report(gaps, "ville").items():
        got, expected = comparable(table), comparable(direct[name])
        assert got.dtypes == expected.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), name


def test_ordered_tables(df):
    report = aggregation_report(df, "ville", ordered=True)
    peaks = [(-r["nombre_evenements"], r["window"]["start"]) for r in report["pics_activite"].collect()]
    assert peaks == sorted(peaks)
    hours = [(r["ville"], r["heure"]) for r in report["agg_ville_heure"].collect()]
    assert hours == sorted(hours)


def test_entities_together_equal_each_alone(df):
    together = precursor_report(df, entity="ville", key="event_id")
    for ville in ["click", "view"]:
        alone = precursor_report(df.filter(df.ville == ville), key="event_id")
        for name, table in alone.items():
            mine = together[name].filter(together[name].ville == ville)
            columns = [c for c in table.columns if c != "ville"]
            assert sorted(map(str, collect(comparable(mine.select(*columns))))) == sorted(
                map(str, collect(comparable(table.select(*columns))))
            ), name


def test_cities_can_be_analysed_as_one(df):
    report = precursor_report(df, key="event_id", ordered=True)
    assert report["precurseurs"].count() == df.count()
    assert report["conditions"].count() == 1


def test_quiet_cities_are_in_the_precursor_report(spark):
    """A city of ten equal values has no major event, and without a tremor no sequence."""
    rows = [(60 * i, "quiet", False, 1.0, 1.0) for i in range(10)]
    rows += [(60 * i, "a", i % 2 == 0, float(i), 1.0) for i in range(10)]
    tables = precursor_report(readings(spark, rows), entity="ville", key="event_id")
    conditions = {r["ville"]: r["nombre_evenements_majeurs"] for r in tables["conditions"].collect()}
    assert conditions == {"a": 1, "quiet": 0}
    counted = {(r["ville"], r["nombre"]) for r in tables["statistiques"].collect()}
    assert counted == {("a", 5), ("quiet", 0)}
