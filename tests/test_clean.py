from __future__ import annotations

import math
from datetime import datetime

import pytest

from faultline.operators.clean import clean_readings, rejects
from faultline.operators.rollups import hour_profile, window_stats
from faultline.schemas import CITY_READINGS_TABLE, CLEAN_READINGS, RAW_CITY_READINGS, RAW_READINGS
from faultline.sources import catalog, readers, sinks
from helpers import collect

RAW = [
    ("2024-01-01 00:00:00", "True", "1.5", "1.04"),
    ("2024-01-01 00:30:00", "False", "abc", None),
    ("2024-13-01 00:00:00", "true", "NaN", "NaN"),
    ("not a time", None, None, "1.10"),
    (None, "maybe", "0.0", "x"),
]


def raw(spark):
    return spark.createDataFrame(RAW, RAW_READINGS)


def test_types_and_fill(spark):
    rows = collect(clean_readings(raw(spark)))
    assert rows == [
        (datetime(2024, 1, 1), True, 1.5, 1.04),
        (datetime(2024, 1, 1, 0, 30), False, 0.0, 0.0),
        (None, True, 0.0, 0.0),
        (None, None, 0.0, 1.1),
        (None, None, 0.0, 0.0),
    ]
    assert dict(clean_readings(raw(spark)).dtypes) == {
        "date": "timestamp",
        "secousse": "boolean",
        "magnitude": "double",
        "tension_entre_plaque": "double",
    }


def test_without_fill_keeps_gaps(spark):
    rows = collect(clean_readings(raw(spark), fill=None))
    assert rows[1][2:] == (None, None)
    assert math.isnan(rows[2][2]) and math.isnan(rows[2][3])


def test_already_typed_input_is_kept(spark):
    cleaned = clean_readings(raw(spark))
    assert collect(clean_readings(cleaned)) == collect(cleaned)


def test_rejects_name_the_fields(spark):
    rows = {r["date"]: r["rejected"] for r in rejects(raw(spark)).collect()}
    assert rows == {
        "2024-01-01 00:30:00": ["magnitude"],
        "2024-13-01 00:00:00": ["date"],
        "not a time": ["date"],
        None: ["secousse", "tension_entre_plaque"],
    }


def test_null_times_leave_windows_but_not_hours(spark):
    cleaned = clean_readings(raw(spark))
    assert [r[1] for r in collect(window_stats(cleaned, "15 minutes"), "window")] == [1, 1]
    assert {r[0]: r[1] for r in collect(hour_profile(cleaned))} == {0: 2, None: 3}


def test_csv_round_trip_keeps_cleaned_readings(spark, tmp_path):
    cleaned = clean_readings(raw(spark))
    sinks.write_csv(raw(spark), str(tmp_path / "raw"))
    landed = readers.read_csv(spark, str(tmp_path / "raw"), RAW_READINGS)
    assert collect(clean_readings(landed), "date", "magnitude", "tension_entre_plaque") == collect(
        cleaned, "date", "magnitude", "tension_entre_plaque"
    )


def test_cleaned_csv_is_read_back_as_it_was(spark, tmp_path):
    cleaned = clean_readings(raw(spark))
    sinks.write_csv(cleaned, str(tmp_path / "clean"))
    back = readers.read_csv(spark, str(tmp_path / "clean"), CLEAN_READINGS)
    assert sorted(map(str, back.collect())) == sorted(map(str, cleaned.collect()))


def test_other_headers_are_refused(spark, tmp_path):
    sinks.write_csv(raw(spark).select("secousse", "date", "magnitude"), str(tmp_path / "odd"))
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "odd"), RAW_READINGS).collect()


def test_partitioned_parquet(spark, tmp_path):
    cleaned = clean_readings(raw(spark)).selectExpr("*", "to_date(date) AS jour")
    sinks.write_parquet(cleaned, str(tmp_path / "t"), partition_by=["jour"])
    assert readers.read_parquet(spark, str(tmp_path / "t")).count() == len(RAW)


def test_database_and_external_tables(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "Tokyo", "True", "1.5", "1.04")] * 4
    sinks.write_csv(spark.createDataFrame(rows, RAW_CITY_READINGS), str(tmp_path / "city"))
    catalog.create_database(spark, "sensors", str(tmp_path / "db"))
    catalog.create_database(spark, "sensors", str(tmp_path / "db"))
    assert "sensors" in [r[0] for r in collect(catalog.show_databases(spark))]
    catalog.use_database(spark, "sensors")
    try:
        table = catalog.external_csv(spark, "villes", str(tmp_path / "city"), CITY_READINGS_TABLE)
        assert collect(table) == [("2024-01-01 00:00:00", "Tokyo", True, 1.5, 1.04)] * 4
        assert catalog.external_csv(spark, "villes", "/nowhere", CITY_READINGS_TABLE).count() == 4
        assert catalog.preview(spark, "villes").count() == 3
        described = {r["col_name"]: r["data_type"] for r in catalog.describe_table(spark, "villes").collect()}
        assert described["secousse"] == "boolean" and described["magnitude"] == "double"
    finally:
        catalog.use_database(spark, "default")
        spark.sql("DROP TABLE IF EXISTS sensors.villes")
