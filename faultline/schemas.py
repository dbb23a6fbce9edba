"""Input and table schemas and formats."""

from __future__ import annotations

from pyspark.sql import types as T


# --- fixed values: formats and schemas of the files, tables and messages -----------------------
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

RENAMES = {"tension entre plaque": "tension_entre_plaque"}

# Landed CSV files are read as text and typed by `clean_readings`, so a bad field never costs a row.
RAW_READINGS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("secousse", T.StringType()),
        T.StructField("magnitude", T.StringType()),
        T.StructField("tension entre plaque", T.StringType()),
    ]
)
RAW_CITY_READINGS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("ville", T.StringType()),
        T.StructField("secousse", T.StringType()),
        T.StructField("magnitude", T.StringType()),
        T.StructField("tension entre plaque", T.StringType()),
    ]
)

# Cleaned readings, for reading them back from CSV.
CLEAN_READINGS = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("secousse", T.BooleanType()),
        T.StructField("magnitude", T.DoubleType()),
        T.StructField("tension_entre_plaque", T.DoubleType()),
    ]
)
CLEAN_CITY_READINGS = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("ville", T.StringType()),
        T.StructField("secousse", T.BooleanType()),
        T.StructField("magnitude", T.DoubleType()),
        T.StructField("tension_entre_plaque", T.DoubleType()),
    ]
)

# External tables over the same files, typed by the table definition.
READINGS_TABLE = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("secousse", T.BooleanType()),
        T.StructField("magnitude", T.DoubleType()),
        T.StructField("tension_entre_plaque", T.DoubleType()),
    ]
)
CITY_READINGS_TABLE = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("ville", T.StringType()),
        T.StructField("secousse", T.BooleanType()),
        T.StructField("magnitude", T.DoubleType()),
        T.StructField("tension_entre_plaque", T.DoubleType()),
    ]
)

# Published hourly statistics. Counts are BIGINT, as Parquet stores them.
HOURLY_STATS_TABLE = T.StructType(
    [
        T.StructField("window_start", T.StringType()),
        T.StructField("nombre_observations", T.LongType()),
        T.StructField("nombre_secousses", T.LongType()),
        T.StructField("magnitude_moyenne", T.DoubleType()),
        T.StructField("magnitude_max", T.DoubleType()),
        T.StructField("tension_moyenne", T.DoubleType()),
    ]
)

# JSON messages of the stream, in the text column `value`.
MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("secousse", T.BooleanType()),
        T.StructField("magnitude", T.DoubleType()),
        T.StructField("tension_entre_plaque", T.DoubleType()),
    ]
)
# -----------------------------------------------------------------------------------------------
