from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from faultline.plans.daily import TABLES, publish_days
from faultline.sources.readers import read_days
from faultline.sources.sinks import write_days
from helpers import START, readings

DAYS = [START.date() + timedelta(days=i) for i in range(3)]


def some(spark):
    """Readings of three days with frames across midnight, and one without a time."""
    seconds = [0, 10, 86_000, 86_399, 86_400, 86_401, 89_900, 90_000, 170_000, 172_799, 172_800, 176_000, None]
    rows = [(t, "ab"[i % 2], i % 3 > 0, float(i), 1 + i / 100) for i, t in enumerate(seconds)]
    return readings(spark, rows)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("table", list(TABLES))
@pytest.mark.parametrize("entity", [None, "ville"])
def test_a_rerun_of_one_day_equals_the_full_run(spark, tmp_path, table, entity):
    source, full, parts = (str(tmp_path / n) for n in ("in", "full", "parts"))
    write_days(some(spark), source, "date")
    publish_days(spark, source, full, table, entity=entity)
    for day in DAYS:
        publish_days(spark, source, parts, table, day, day, entity=entity)
    dated = spark.read.parquet(full).filter("jour IS NOT NULL")
    assert rows(spark.read.parquet(parts).select(dated.columns)) == rows(dated)
    # A changed day replaces itself alone.
    changed = some(spark).filter("to_date(date) = '2024-01-02'").withColumn("magnitude", F.lit(7.0))
    write_days(changed, source, "date")
    publish_days(spark, source, parts, table, DAYS[1], DAYS[1], entity=entity)
    again = spark.read.parquet(parts)
    first = "jour = '2024-01-01'"
    assert rows(again.filter(first).select(dated.columns)) == rows(dated.filter(first))
    assert rows(again.filter(f"NOT {first}").select(dated.columns)) != rows(dated.filter(f"NOT {first}"))


def test_only_the_days_are_read(spark, tmp_path):
    write_days(some(spark), str(tmp_path / "in"), "date")
    found = read_days(spark, str(tmp_path / "in"), DAYS[1], DAYS[1], look_back_seconds=3600)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(jour" in plan and "jour#" in plan.split("PartitionFilters")[1]
    assert {r.date.date() for r in found.collect()} == {DAYS[0], DAYS[1]}
    assert min(r.date for r in found.collect()) == START + timedelta(seconds=86_000)
    assert read_days(spark, str(tmp_path / "in"), date(2030, 1, 1)).count() == 0
