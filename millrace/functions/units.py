"""Temperature conversion as a column expression and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def to_celsius(unit: Column, temp: Column) -> Column:
    return F.when(unit == "F", (temp - 32) * 5 / 9).otherwise(temp)


def register_to_celsius(spark: SparkSession, name: str = "to_celsius") -> None:
    """The same conversion for SQL text; Catalyst inlines the body."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(unit STRING, temp DOUBLE) RETURNS DOUBLE "
        "RETURN CASE WHEN unit = 'F' THEN (temp - 32) * 5 / 9 ELSE temp END"
    )
