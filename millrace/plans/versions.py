"""Upsert and cache queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import sinks
from millrace.operators.merge import merge, merge_partitions
from millrace.plans.registry import query

# Renamed BUILDING customers match; MACHINERY customers under new keys do not.
_MERGED = """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' New name' ELSE c_name END AS c_name,
                    c_nationkey, c_acctbal, c_mktsegment FROM customer
             UNION ALL
             SELECT c_custkey + 1000000000000, c_name, c_nationkey, NULL, NULL FROM customer
             WHERE c_mktsegment = 'MACHINERY'"""


def _changes(t):
    renamed = t.customer.where("c_mktsegment = 'BUILDING'").withColumn(
        "c_name", F.concat("c_name", F.lit(" New name"))
    )
    added = t.customer.where("c_mktsegment = 'MACHINERY'").withColumn(
        "c_custkey", F.col("c_custkey") + 1_000_000_000_000
    )
    return renamed.unionByName(added)


_KEYS, _INSERT = ["c_custkey", "c_nationkey"], ["c_custkey", "c_nationkey", "c_name"]


@query("merge_upsert", _MERGED)
def merge_upsert(t):
    return merge(t.customer, _changes(t), _KEYS, ["c_name"], _INSERT)


@query(
    "merge_upsert_all",
    """WITH s AS (SELECT l_shipdate::DATE AS ds, l_returnflag, sum(l_quantity) AS y FROM lineitem GROUP BY ALL)
       SELECT ds, l_returnflag, round(CASE WHEN ds >= DATE '1998-01-01' THEN y * 2 ELSE y END, 2) AS y,
              CASE WHEN ds >= DATE '1998-01-01' THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS training_date
       FROM s""",
)
def merge_upsert_all(t):
    series = t.lineitem.groupBy(F.to_date("l_shipdate").alias("ds"), "l_returnflag").agg(
        F.sum("l_quantity").alias("y")
    )
    series = t.workspace().keep(series, "series")  # both sides of the merge come from it
    stored = series.where("ds < DATE '1999-01-01'").withColumn("training_date", F.lit("2024-01-01").cast("date"))
    new = series.where("ds >= DATE '1998-01-01'").select(
        "ds", "l_returnflag", (F.col("y") * 2).alias("y"), F.lit("2024-02-01").cast("date").alias("training_date")
    )
    return merge(stored, new, ["ds", "l_returnflag"]).withColumn("y", F.round("y", 2))


@query(
    "merge_partitioned",
    """WITH s AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, o_orderstatus, count(*) AS ct FROM orders GROUP BY ALL)
       SELECT month, o_orderstatus, CASE WHEN month >= DATE '2000-01-01' THEN ct + 1 ELSE ct END AS ct FROM s""",
)
def merge_partitioned(t):
    """Monthly counts stored by month; the months from 2000 on are corrected, the others left as they are."""
    space = t.workspace()
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "MM").alias("month"), "o_orderstatus").agg(F.count("*").alias("ct"))
    sinks.write_partitioned(monthly.where("month < DATE '2001-01-01'"), space.path("monthly"), ["month"])
    corrected = monthly.where("month >= DATE '2000-01-01'").withColumn("ct", F.col("ct") + 1)
    merge_partitions(t.spark, space.path("monthly"), corrected, ["month", "o_orderstatus"], "month", space.path("staging"))
    return t.spark.read.parquet(space.path("monthly")).select("month", "o_orderstatus", "ct")


@query(
    "cached_subset",
    "SELECT c_nationkey, count(*) AS ct FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1",
)
def cached_subset(t):
    t.spark.sql("UNCACHE TABLE IF EXISTS millrace_building")
    t.spark.sql("DROP VIEW IF EXISTS millrace_building")
    t.spark.sql(
        f"""CACHE LAZY TABLE millrace_building OPTIONS ('storageLevel' 'MEMORY_AND_DISK')
           AS SELECT * FROM {t.view("customer")} WHERE c_mktsegment = 'BUILDING'"""
    )
    return t.spark.table("millrace_building").groupBy("c_nationkey").agg(F.count("*").alias("ct"))
