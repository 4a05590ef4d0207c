"""Writers: managed and partitioned tables, file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", **options) -> None:
    """Partition folders, with the rows of each folder gathered first.

    ``rebalance`` gathers rows by the partition columns so a folder gets few
    files, and lets AQE split a folder that is too large for one task.
    """
    df.hint("rebalance", *by).write.mode(mode).options(**options).partitionBy(*by).parquet(path)


def write_files(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**options).format(fmt).save(path)


def write_json_arrays(df: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Files that each hold one JSON array, spread over several lines.

    An array takes up to ``per_file`` records that follow one another in a
    partition, so no file and no task grows with the table.
    """
    record = F.to_json(F.struct(*df.columns))
    placed = df.select(record.alias("value"), F.monotonically_increasing_id().alias("_row"))
    groups = placed.groupBy(F.floor(F.col("_row") / per_file).alias("_file")).agg(F.collect_list("value").alias("_records"))
    array = F.concat(F.lit("[\n"), F.array_join("_records", ",\n"), F.lit("\n]"))
    write_files(groups.select(array.alias("value")), path, "text", maxRecordsPerFile=1)
