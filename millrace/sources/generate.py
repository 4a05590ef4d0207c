"""Generated rows and small local frames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Mean and standard deviation of each unit's readings.
TEMPERATURES = {"F": (55.0, 25.0), "C": (10.0, 10.0)}


def temperature_readings(ids: DataFrame, seed: int = 7) -> DataFrame:
    """One normal reading per row of ``ids`` and unit, made on the executors.

    The readings of all units come interleaved, without a shuffle.
    """
    unit = F.explode(F.array(*[F.lit(u) for u in TEMPERATURES])).alias("unit")
    drawn = ids.select("*", unit).withColumn("_z", F.randn(seed))
    mean, spread = (
        F.create_map(*[F.lit(x) for u, pair in TEMPERATURES.items() for x in (u, pair[i])])[F.col("unit")]
        for i in (0, 1)
    )
    return drawn.withColumn("temp", mean + spread * F.col("_z")).drop("_z")


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema=None) -> DataFrame:
    """A local frame as a distributed table, over Arrow."""
    return spark.createDataFrame(frame, schema)


def to_pandas(df: DataFrame, at_most: int) -> pd.DataFrame:
    """A result as a local frame; refuses one with more than ``at_most`` rows."""
    frame = df.limit(at_most + 1).toPandas()
    if len(frame) > at_most:
        raise ValueError(f"result has more than {at_most} rows; aggregate it first")
    return frame
