"""In-memory rows and DataFrames interpolated into SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Small literal tables (tests, lookup lists).  ``schema`` may be a list of
    names (types inferred from the values) or a DDL string."""
    return spark.createDataFrame(rows, schema)


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL where ``{name}`` placeholders refer to DataFrames, e.g.
    ``sql_over(spark, "SELECT * FROM {words}", words=df)``."""
    return spark.sql(query, **frames)
