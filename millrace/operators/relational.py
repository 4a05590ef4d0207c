"""Relational helpers that Spark has no single call for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def time_range(df: DataFrame, column: str | None, start=None, end=None) -> DataFrame:
    """Rows with ``start <= column < end``; a missing bound is open."""
    if column and start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if column and end is not None:
        df = df.where(F.col(column) < F.lit(end))
    return df


def underscore_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.toDF(*[name.replace(" ", "_") for name in df.columns])


def share_of_total(df: DataFrame, by: Sequence[str], digits: int = 2) -> DataFrame:
    """Rows per group and their percentage of all rows.

    The total is a scalar subquery over the grouped counts, not a window
    without a partition, which would pull every row into one task.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("ct"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("total", total).withColumn("pct", F.round(F.col("ct") / F.col("total") * 100, digits))


def percent_where(condition: Column) -> Column:
    """Aggregate: percentage of the group's rows that meet ``condition``."""
    return F.sum(F.when(condition, 1).otherwise(0)) / F.count("*") * 100


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``.

    A ``min`` over structs combines on the map side, so a hot key costs one
    row per input partition rather than a sort of all its rows.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def pivot_shares(
    df: DataFrame, by: str, column: str, values: dict[str, str], numerator: str, out: str
) -> DataFrame:
    """Counts of the named values side by side and one of them as a percentage of their sum.

    ``values`` maps a value of ``column`` to its output name. Naming them
    spares Spark a pass to find them. Missing cells count as zero in the ratio.
    """
    wide = df.groupBy(by).pivot(column, list(values)).agg(F.count(F.lit(1)))
    wide = wide.select(by, *[F.col(v).alias(name) for v, name in values.items()])
    whole = sum((F.coalesce(F.col(n), F.lit(0)) for n in values.values()), F.lit(0))
    return wide.withColumn(out, F.try_divide(F.coalesce(F.col(numerator), F.lit(0)), whole) * 100)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column as rows ``(column_name, nulls)``, from a single pass."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "nulls")
