"""SQL table sinks: ``INSERT INTO`` a declared table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_table(spark: SparkSession, name: str, ddl_columns: str, location: str, fmt: str = "parquet") -> None:
    """Declare a table over a folder (as a DDL with a connector clause does)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING {fmt} LOCATION '{location}'")


def insert_into(spark: SparkSession, table: str, query: str, **frames: DataFrame) -> None:
    """``INSERT INTO table SELECT ...`` where ``{name}`` refers to DataFrames."""
    spark.sql(f"INSERT INTO {table} {query}", **frames)
