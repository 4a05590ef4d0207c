"""Time-windowed feature tables and lookups into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import sinks
from millrace.functions import dates
from millrace.operators.relational import time_range


def pickup_features(trips: DataFrame, zip_code: str, ts: str, fare: str, start=None, end=None) -> DataFrame:
    """Mean fare and trips per zip over one hour, every 15 minutes.

    Trips are first summed per 15-minute pane, and each pane then goes into its
    four windows. Only panes are multiplied, never trips.
    """
    panes = (
        time_range(trips, ts, start, end)
        .groupBy(F.col(zip_code).alias("zip"), F.window(ts, "15 minutes").alias("_w"))
        .agg(F.sum(fare).alias("_sum"), F.count(fare).alias("_fares"), F.count("*").alias("_trips"))
    )
    first, step = F.col("_w.end"), F.expr("INTERVAL 15 MINUTES")
    ends = F.sequence(first, first + F.expr("INTERVAL 45 MINUTES"), step)
    windows = panes.withColumn("_end", F.explode(ends)).groupBy("zip", "_end")
    return windows.agg(F.sum("_sum").alias("_sum"), F.sum("_fares").alias("_fares"), F.sum("_trips").alias("_n")).select(
        "zip",
        F.unix_timestamp("_end").cast("int").alias("ts"),
        dates.year_month("_end").alias("yyyy_mm"),
        F.try_divide("_sum", "_fares").cast("float").alias("mean_fare_window_1h_pickup_zip"),
        F.col("_n").cast("int").alias("count_trips_window_1h_pickup_zip"),
    )


def dropoff_features(trips: DataFrame, zip_code: str, ts: str, start=None, end=None) -> DataFrame:
    """Trips per zip in half hours, and whether the half hour ends on a weekend."""
    windows = time_range(trips, ts, start, end).groupBy(
        F.col(zip_code).alias("zip"), F.window(ts, "30 minutes").alias("_w")
    )
    return windows.agg(F.count("*").alias("_n")).select(
        "zip",
        F.unix_timestamp("_w.end").cast("int").alias("ts"),
        dates.year_month("_w.end").alias("yyyy_mm"),
        F.col("_n").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        dates.is_weekend("_w.end").alias("dropoff_is_weekend"),
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; computing them raises an error if a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    broken = F.raise_error(F.lit(f"duplicate primary key ({', '.join(keys)})")).cast("boolean")
    checked = once.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(broken))
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def write_feature_table(df: DataFrame, path: str, keys: Sequence[str], partition: str) -> None:
    """A table with a unique key, in folders by ``partition``."""
    sinks.write_partitioned(require_unique(df, keys), path, [partition])


def lookup(df: DataFrame, features: DataFrame, on: dict[str, str]) -> DataFrame:
    """Add a feature table's columns by key; ``on`` maps columns of ``df`` to feature keys.

    A left join, so rows without features stay. AQE broadcasts the feature
    table if its measured size allows and otherwise splits skewed keys.
    """
    values = [c for c in features.columns if c not in on.values() and c != "yyyy_mm"]
    side = features.select(*[F.col(f).alias(f"_f_{f}") for f in on.values()], *values)
    condition = None
    for own, feature in on.items():
        equal = F.col(own) == F.col(f"_f_{feature}")
        condition = equal if condition is None else condition & equal
    return df.join(side, condition, "left").drop(*[f"_f_{f}" for f in on.values()])


def training_set(
    trips: DataFrame, zip_code: str, pickup_ts: str, dropoff_ts: str, pickup: DataFrame, dropoff: DataFrame,
    as_of: str = "ceil",
) -> DataFrame:
    """Trips with both feature sets, looked up by zip and rounded time.

    ``ceil`` takes the window that ends at the rounded-up time and so covers
    trips up to that end, also later ones than the trip itself. ``floor`` takes
    the last window that had ended when the trip began.
    """
    if as_of not in ("ceil", "floor"):
        raise ValueError("as_of is 'ceil' or 'floor'")
    rounded = dates.round_up if as_of == "ceil" else dates.round_down
    keyed = trips.withColumns({"_pickup": rounded(pickup_ts, 15), "_dropoff": rounded(dropoff_ts, 30)})
    found = lookup(keyed, pickup, {zip_code: "zip", "_pickup": "ts"})
    found = lookup(found, dropoff, {zip_code: "zip", "_dropoff": "ts"})
    return found.withColumnsRenamed({"_pickup": "rounded_pickup_datetime", "_dropoff": "rounded_dropoff_datetime"})
