"""Databases and external tables over landed files and published results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")


def preview(spark: SparkSession, table: str, n: int = 3) -> DataFrame:
    """Any `n` rows."""
    return spark.table(table).limit(n)


def external_csv(spark: SparkSession, table: str, path: str, schema: StructType) -> DataFrame:
    """Create, if missing, a table over CSV files whose first line is a header."""
    return _external(spark, table, path, "csv", schema, header="true")


def external_parquet(spark: SparkSession, table: str, path: str, schema: StructType) -> DataFrame:
    """Create, if missing, a table over Parquet files. Declare counts as BIGINT, as they are stored."""
    return _external(spark, table, path, "parquet", schema)


def _external(
    spark: SparkSession, table: str, path: str, fmt: str, schema: StructType, **options: str
) -> DataFrame:
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source=fmt, schema=schema, **options)
    return spark.table(table)
