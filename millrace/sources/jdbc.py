"""Warehouse tables over JDBC, read and written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, driver: str | None = None, **properties) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **{k: str(v) for k, v in properties.items()}}
    if driver:
        options["driver"] = driver
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower=None,
    upper=None,
    partitions: int = 1,
    **properties,
) -> DataFrame:
    """A table, cut by ranges of ``column`` so that many tasks read it.

    Rows outside ``lower``/``upper`` are still read, by the outermost ranges.
    """
    options = jdbc_options(url, table, **properties)
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    elif partitions > 1:
        raise ValueError("partitions need a column with lower and upper bounds")
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", batch: int = 10_000, **properties) -> None:
    options = jdbc_options(url, table, batchsize=batch, **properties)
    df.write.format("jdbc").options(**options).mode(mode).save()
