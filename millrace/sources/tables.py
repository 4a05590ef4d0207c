"""Catalog tables: external, located, described."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def external_csv_table(spark: SparkSession, name: str, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING CSV "
        f"OPTIONS (path '{path}', header 'true', inferSchema 'true', mode '{mode}')"
    )
    return spark.table(name)


def located_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A table over files that already exist at ``path``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a table, without partition and detail lines."""
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema], "col_name string, data_type string"
    )
