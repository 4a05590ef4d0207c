"""Upsert of a source into a target, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import sinks


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """The target after a merge on ``keys``; null keys match nothing.

    Matched rows take the ``update`` columns from the source (default: all but
    the keys). Unmatched source rows are added with the ``insert`` columns
    (default: all), the rest null. Two source rows for one target row raise an
    error when the result is computed.

    Target and source are joined as a left join plus an anti join rather than
    a full outer join, since Spark can split a skewed side of those two. The
    source goes in as one row per key, so a repeated key does not multiply.
    Which source rows match is asked from the source's side: target keys are
    cut down to the source's by a semi join, where a small source is broadcast
    and the target's keys stay where they are.
    """
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    insert = list(target.columns) if insert is None else list(insert)

    per_key = source.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.count("*").alias("_matches"), F.first(F.struct(*keys, *update)).alias("_new")
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    # A row filter, so that no choice of columns spares the check.
    ambiguous = F.raise_error(F.lit(f"several source rows match one target row on {', '.join(keys)}")).cast("boolean")
    single = F.when(F.coalesce("_matches", F.lit(0)) <= 1, F.lit(True)).otherwise(ambiguous)

    def merged(name: str):
        if name not in update:
            return F.col(name)
        new = F.col(f"_new.{name}").cast(target.schema[name].dataType)
        return F.when(F.col("_matches").isNull(), F.col(name)).otherwise(new).alias(name)

    kept = target.join(per_key, same, "left").where(single).select(*[merged(c) for c in target.columns])
    matched = target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()
    fresh = source.join(matched, list(keys), "left_anti").select(
        *[
            (F.col(c) if c in insert else F.lit(None)).cast(target.schema[c].dataType).alias(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(fresh)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    staging: str,
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> int:
    """Merge into a partitioned folder and rewrite only the partitions the source touches.

    The partition column must be one of the keys, so a row can match within its
    own partition only. Returns the number of partitions written. The merged
    rows are complete in ``staging`` before they replace anything; should the
    last step die, overwriting again from there gives the same table.
    """
    if partition not in keys:
        raise ValueError(f"partition column {partition} is not a merge key")
    source.write.mode("overwrite").parquet(f"{staging}/source")
    changes = spark.read.parquet(f"{staging}/source")
    # As many values as folders to rewrite: a list here prunes the scan below.
    touched = [row[0] for row in changes.select(partition).distinct().collect()]
    if None in touched:
        raise ValueError(f"source has rows without {partition}")
    if not touched:
        return 0
    old = spark.read.parquet(path).where(F.col(partition).isin(touched))
    sinks.write_partitioned(merge(old, changes, keys, update, insert), f"{staging}/merged", [partition])
    merged = spark.read.schema(old.schema).parquet(f"{staging}/merged")
    sinks.write_partitioned(merged, path, [partition], partitionOverwriteMode="dynamic")
    return len(touched)
