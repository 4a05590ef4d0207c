"""Data profile, histogram and box-plot statistics of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import exact_percentiles, matched

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _long(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    numbers = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(list(keep), list(columns), "column_name", "value")


def summarize(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, stddev, min, quartiles and max per column (and group).

    Moments are built-in aggregates of one scan, one row per group; quartiles
    take two more scans (:func:`~millrace.operators.ordered.exact_percentiles`).
    A column of a group that holds nulls only has a row as well.
    """
    keys = [*by, "column_name"]
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    facts = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    each = [F.struct(F.lit(c).alias("column_name"), *[f(c).alias(n) for n, f in facts.items()]) for c in columns]
    wide = numbers.groupBy(*by).agg(F.array(*each).alias("_facts"))
    moments = wide.select(*by, F.inline("_facts"))
    quartiles = exact_percentiles(_long(df, by, columns), keys, "value", QUARTILES)
    return matched(moments, quartiles, keys, "left").select(*keys, *facts, *QUARTILES)


def boxplot(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Quartiles, and whiskers at the last value within 1.5 IQR, per column and group."""
    keys = [*by, "column_name"]
    cells = _long(df, by, columns).where(F.col("value").isNotNull())
    fences = (
        exact_percentiles(cells, keys, "value", QUARTILES)
        .withColumn("_low", F.col("p25") - 1.5 * (F.col("p75") - F.col("p25")))
        .withColumn("_high", F.col("p75") + 1.5 * (F.col("p75") - F.col("p25")))
    )
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        matched(cells, fences, keys)
        .groupBy(*keys, *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(1)).alias("outliers"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the column's own minimum and maximum."""
    span = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    width = (F.col("_span.hi") - F.col("_span.lo")) / bins
    place = F.least(F.floor(F.try_divide(F.col(column) - F.col("_span.lo"), width)), F.lit(bins - 1))
    place = F.when(width == 0, 0).otherwise(place)
    return (
        df.where(F.col(column).isNotNull())
        .select(column)
        .withColumn("_span", span)
        .select(place.cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("ct"))
    )
