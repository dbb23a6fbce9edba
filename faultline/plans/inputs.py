"""The `events` table seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_KEY = "event_id"
EVENT_ENTITY = "ville"


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a key and an entity. Hours and epoch seconds are those of UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return events.select(
        F.col("event_id"),
        F.col("ts").alias("date"),
        F.col("event_type").alias("ville"),
        (F.col("value") >= 50.0).alias("secousse"),
        F.col("value").alias("magnitude"),
        (F.lit(1.0) + k / 1000).alias("tension_entre_plaque"),
    )


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same readings as raw text, with the defects that landed files have.

    Each city spells its flag in its own way or not at all; small magnitudes are garbled, missing
    or NaN, and some times have no such month.
    """
    r = event_readings(spark, sf_dir)
    flag = F.col("secousse").cast("string")
    no_month = (F.col("ville") == "signup") & (F.col("magnitude") < 5)
    return r.select(
        "event_id",
        F.when(no_month, "2024-13-01 00:00:00")
        .otherwise(F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
        .alias("date"),
        "ville",
        F.when(F.col("ville") == "click", F.initcap(flag))
        .when(F.col("ville") == "purchase", F.upper(flag))
        .when(F.col("ville") == "error", "maybe")
        .when(F.col("ville") == "view", flag)
        .alias("secousse"),
        F.when(F.col("magnitude") < 2, "abc")
        .when(F.col("magnitude") < 4, None)
        .when(F.col("magnitude") < 5, "NaN")
        .otherwise(F.col("magnitude").cast("string"))
        .alias("magnitude"),
        F.col("tension_entre_plaque").cast("string").alias("tension entre plaque"),
    )
