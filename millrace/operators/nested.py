"""Building and flattening documents with arrays of structs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders with their lines as an array of structs, one row per order.

    A document's lines are one value and so have to fit in a row in any case.
    """
    line = F.struct(
        F.col("l_linenumber").alias("number"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
        F.to_date("l_shipdate").alias("shipped"),
    )
    documents = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return orders.join(documents, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def explode_struct(df: DataFrame, column: str) -> DataFrame:
    """One row per element of an array of structs, its fields as columns."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias("_item")).select(*rest, "_item.*")


def explode_all(df: DataFrame, arrays: dict[str, Column | str]) -> DataFrame:
    """Explode several arrays of a row one after the other.

    Gives every combination within the row; a row with an empty array vanishes.
    """

    def one(frame: DataFrame, item) -> DataFrame:
        name, array = item
        return frame.withColumn(name, F.explode(array))

    return reduce(one, arrays.items(), df)


def flag_sum_by(df: DataFrame, entity: Sequence[str], category: str, flag: Column, out: str) -> DataFrame:
    """Entities per category that meet ``flag``, each counted once per category."""
    pairs = df.select(*entity, category, F.when(flag, 1).otherwise(0).alias("_flag")).distinct()
    return pairs.groupBy(category).agg(F.sum("_flag").alias(out))
