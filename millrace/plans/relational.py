"""Projection, filter, join, aggregate, window, sort and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import profile, relational as rel
from millrace.operators.ordered import exact_percentiles, numbered
from millrace.plans.registry import query

SEGMENTS = ("BUILDING", "FURNITURE")


# ---- projections -----------------------------------------------------------


@query("select_cols", "SELECT o_orderkey, o_orderstatus FROM orders")
def select_cols(t):
    return t.orders.select("o_orderkey", "o_orderstatus")


@query("select_expr", "SELECT n_nationkey, upper(lower(n_name)) AS upp_name FROM nation")
def select_expr(t):
    return t.nation.selectExpr("n_nationkey", "upper(lower(n_name)) AS upp_name")


@query(
    "add_rename_drop",
    """SELECT p_partkey, p_name AS part_name, p_brand, p_type, p_size, round(p_retailprice * 1.1, 2) AS gross_price
       FROM part""",
)
def add_rename_drop(t):
    return (
        t.part.withColumn("gross_price", F.round(F.col("p_retailprice") * 1.1, 2))
        .withColumnsRenamed({"p_name": "part_name"})
        .drop("p_retailprice")
    )


@query(
    "bulk_rename",
    "SELECT p_partkey AS part_key, p_name AS part_name, p_size AS part_size FROM part",
)
def bulk_rename(t):
    spaced = t.part.select("p_partkey", "p_name", "p_size").toDF("part key", "part name", "part size")
    return rel.underscore_names(spaced)


@query(
    "tagged_union",
    """SELECT c_name AS name, c_acctbal AS acctbal, 1 AS is_customer FROM customer
       UNION ALL SELECT s_name, s_acctbal, 0 FROM supplier""",
)
def tagged_union(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return customers.withColumn("is_customer", F.lit(1)).unionByName(suppliers.withColumn("is_customer", F.lit(0)))


# ---- filters ---------------------------------------------------------------


@query("filter_lt", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.03")
def filter_lt(t):
    return t.lineitem.where(F.col("l_discount") < 0.03).select("l_orderkey", "l_linenumber", "l_discount")


@query("filter_in", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')")
def filter_in(t):
    return t.customer.where(F.col("c_mktsegment").isin(*SEGMENTS))


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt%'")
def filter_like(t):
    return t.part.where(F.col("p_name").like("%bolt%")).select("p_partkey", "p_name")


@query(
    "filter_eq_and",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def filter_eq_and(t):
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.where(wanted).select("o_orderkey", "o_totalprice")


@query(
    "filter_null",
    """SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
       WHERE o_orderkey IS NULL""",
)
def filter_null(t):
    finished = t.orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
    joined = t.customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(F.col("o_orderkey").isNull()).select("c_custkey", "c_name")


@query(
    "time_range_filter",
    """SELECT event_id, user_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
)
def time_range_filter(t):
    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    end = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return rel.time_range(t.events, "ts", start, end).select("event_id", "user_id")


@query(
    "drop_nulls",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey
       WHERE o_orderkey IS NOT NULL""",
)
def drop_nulls(t):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "o_orderkey").dropna("any")


@query(
    "param_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_totalprice >= 100000",
)
def param_filter(t):
    return t.spark.sql(
        "SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderpriority = :priority AND o_totalprice >= :least",
        args={"priority": "2-HIGH", "least": 100000},
        orders=t.orders,
    )


@query(
    "null_counts",
    """WITH j AS (SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
                  LEFT JOIN orders ON o_custkey = c_custkey)
       SELECT 'c_custkey' AS column_name, count(*) - count(c_custkey) AS nulls FROM j
       UNION ALL SELECT 'c_name', count(*) - count(c_name) FROM j
       UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey) FROM j
       UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM j""",
)
def null_counts(t):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rel.null_counts(joined, ["c_custkey", "c_name", "o_orderkey", "o_totalprice"])


# ---- joins -----------------------------------------------------------------


@query(
    "segment_order_totals",
    """SELECT c_mktsegment, o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) AS sum_order_total
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey
       WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')
       GROUP BY ALL""",
)
def segment_order_totals(t):
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return (
        joined.where(F.col("c_mktsegment").isin(*SEGMENTS))
        .groupBy("c_mktsegment", "o_orderpriority", "o_orderstatus")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("sum_order_total"))
        .orderBy(F.desc("sum_order_total"))
    )


@query(
    "join_using",
    "SELECT n_regionkey AS regionkey, n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey",
)
def join_using(t):
    nations = t.nation.withColumnRenamed("n_regionkey", "regionkey")
    regions = t.region.withColumnRenamed("r_regionkey", "regionkey")
    return nations.join(regions, on="regionkey", how="inner")


@query(
    "join_on",
    "SELECT s_suppkey, s_nationkey, n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def join_on(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "s_nationkey", "n_nationkey", "n_name")


@query(
    "full_outer_merge",
    """WITH p AS (SELECT user_id, count(*) AS purchases, round(sum(value), 2) AS spent
                  FROM events WHERE event_type = 'purchase' GROUP BY user_id),
            e AS (SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id)
       SELECT coalesce(p.user_id, e.user_id) AS user_id, purchases, spent, errors
       FROM p FULL JOIN e ON p.user_id = e.user_id""",
)
def full_outer_merge(t):
    purchases = (
        t.events.where("event_type = 'purchase'")
        .groupBy("user_id")
        .agg(F.count("*").alias("purchases"), F.round(F.sum("value"), 2).alias("spent"))
    )
    errors = t.events.where("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("errors"))
    return purchases.join(errors, "user_id", "full")


# ---- aggregates ------------------------------------------------------------


@query("row_count", "SELECT count(*) AS ct FROM orders")
def row_count(t):
    return t.orders.agg(F.count("*").alias("ct"))


@query("group_count", "SELECT event_type, count(*) AS ct FROM events GROUP BY event_type")
def group_count(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("ct"))


@query(
    "group_stats",
    """SELECT month(l_shipdate)::INTEGER AS mnth, round(avg(l_extendedprice), 4) AS avg_price,
              round(median(l_extendedprice), 4) AS med_price, round(sum(l_quantity), 2) AS sum_qty, count(*) AS ct
       FROM lineitem GROUP BY mnth""",
)
def group_stats(t):
    lines = t.lineitem.select(F.month("l_shipdate").alias("mnth"), "l_extendedprice", "l_quantity")
    moments = lines.groupBy("mnth").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.count("*").alias("ct"),
    )
    medians = exact_percentiles(lines, ["mnth"], "l_extendedprice", {"med_price": 0.5})
    return (
        moments.join(medians, "mnth")
        .withColumn("med_price", F.round("med_price", 4))
        .orderBy(F.desc("avg_price"), "mnth")
    )


@query(
    "multi_key_sum",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
              round(sum(l_extendedprice), 2) AS sum_price
       FROM lineitem GROUP BY ALL""",
)
def multi_key_sum(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
    )


@query("count_ordered", "SELECT user_id, count(*) AS ct FROM events GROUP BY user_id")
def count_ordered(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("ct")).orderBy(F.desc("ct"), "user_id")


@query(
    "having_dupes",
    "SELECT md5(text) AS text_id, count(*) AS ct FROM documents GROUP BY text HAVING count(*) > 1",
)
def having_dupes(t):
    # The digest is what gets shuffled, not the text.
    return t.documents.groupBy(F.md5("text").alias("text_id")).agg(F.count("*").alias("ct")).where("ct > 1")


@query(
    "count_distinct_by_group",
    "SELECT event_type, count(DISTINCT user_id) AS ct_distinct, count(*) AS ct FROM events GROUP BY event_type",
)
def count_distinct_by_group(t):
    return (
        t.events.groupBy("event_type")
        .agg(F.count_distinct("user_id").alias("ct_distinct"), F.count("*").alias("ct"))
        .orderBy(F.desc("ct_distinct"), "event_type")
    )


@query("count_distinct_multi", "SELECT count(DISTINCT (user_id, event_type)) AS ct_distinct FROM events")
def count_distinct_multi(t):
    return t.events.agg(F.count_distinct("user_id", "event_type").alias("ct_distinct"))


@query(
    "pct_flag_by_group",
    """SELECT o_orderpriority, count(*) AS ct_rows,
              round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) * 100, 4) AS pct_finished
       FROM orders GROUP BY o_orderpriority""",
)
def pct_flag_by_group(t):
    return (
        t.orders.groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("ct_rows"),
            F.round(rel.percent_where(F.col("o_orderstatus") == "F"), 4).alias("pct_finished"),
        )
        .orderBy(F.desc("pct_finished"), "o_orderpriority")
    )


@query(
    "pct_flag_distinct",
    """SELECT count(DISTINCT user_id) AS ct_distinct, count(*) AS ct_rows,
              round(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) / count(*) * 100, 4) AS pct_purchase
       FROM (SELECT DISTINCT user_id, event_type FROM events)""",
)
def pct_flag_distinct(t):
    pairs = t.events.select("user_id", "event_type").distinct()
    return pairs.agg(
        F.count_distinct("user_id").alias("ct_distinct"),
        F.count("*").alias("ct_rows"),
        F.round(rel.percent_where(F.col("event_type") == "purchase"), 4).alias("pct_purchase"),
    )


@query(
    "pct_of_total",
    """WITH p AS (SELECT DISTINCT user_id, event_type FROM events)
       SELECT event_type, count(*) AS ct, (SELECT count(*) FROM p) AS total,
              round(count(*) / (SELECT count(*) FROM p) * 100, 2) AS pct
       FROM p GROUP BY event_type""",
)
def pct_of_total(t):
    pairs = t.events.select("user_id", "event_type").distinct()
    return rel.share_of_total(pairs, ["event_type"]).orderBy(F.desc("pct"), "event_type")


@query(
    "pivot_ratio",
    """SELECT o_orderpriority,
              nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS open_orders,
              nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS finished_orders,
              round(count(*) FILTER (o_orderstatus = 'F')
                    / count(*) FILTER (o_orderstatus IN ('O', 'F')) * 100, 4) AS pct_finished
       FROM orders GROUP BY o_orderpriority""",
)
def pivot_ratio(t):
    names = {"O": "open_orders", "F": "finished_orders"}
    shares = rel.pivot_shares(t.orders, "o_orderpriority", "o_orderstatus", names, "finished_orders", "pct_finished")
    return shares.withColumn("pct_finished", F.round("pct_finished", 4))


@query(
    "distinct_values",
    "SELECT string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders",
)
def distinct_values(t):
    found = t.orders.agg(F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"))
    return found.select(F.array_join("statuses", ",").alias("statuses"))


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "dedupe_subset",
    """SELECT event_id, user_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def dedupe_subset(t):
    first = rel.first_per_key(t.events.drop("props"), ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("event_id", "user_id", "event_type", "value")


@query(
    "weekday_trend",
    """SELECT year(l_shipdate)::INTEGER AS year, dayofweek(l_shipdate)::INTEGER AS weekday, round(avg(qty), 4) AS avg_qty
       FROM (SELECT l_shipdate, sum(l_quantity) AS qty FROM lineitem GROUP BY l_shipdate) GROUP BY 1, 2""",
)
def weekday_trend(t):
    daily = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("qty"))
    weekday = (F.dayofweek("day") - 1).alias("weekday")
    return (
        daily.groupBy(F.year("day").alias("year"), weekday)
        .agg(F.round(F.avg("qty"), 4).alias("avg_qty"))
        .orderBy("year", "weekday")
    )


@query(
    "yearly_trend",
    "SELECT year(l_shipdate)::INTEGER AS year, round(sum(l_quantity), 2) AS sum_qty FROM lineitem GROUP BY 1",
)
def yearly_trend(t):
    totals = t.lineitem.groupBy(F.year("l_shipdate").alias("year")).agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"))
    return totals.orderBy("year")


@query(
    "monthly_trend",
    """SELECT date_trunc('month', l_shipdate)::DATE AS month, round(sum(l_quantity), 2) AS sum_qty
       FROM lineitem GROUP BY 1""",
)
def monthly_trend(t):
    month = F.trunc("l_shipdate", "MM").alias("month")
    return t.lineitem.groupBy(month).agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty")).orderBy("month")


@query(
    "distinct_grouped",
    """SELECT DISTINCT o_orderstatus, o_orderdate::DATE AS day, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY 1, 2""",
)
def distinct_grouped(t):
    grouped = t.orders.groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day"))
    return grouped.agg(F.round(F.sum("o_totalprice"), 2).alias("total")).distinct()


@query("series_average", "SELECT ts::DATE AS day, round(avg(value), 4) AS avg_value FROM events GROUP BY 1")
def series_average(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 4).alias("avg_value"))


# ---- profiles --------------------------------------------------------------


@query(
    "profile_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
                   round(stddev_samp({c}), 4) AS stddev, min({c})::DOUBLE AS min,
                   round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
                   round(quantile_cont({c}, 0.75), 4) AS p75, max({c})::DOUBLE AS max FROM {table}"""
        for table, c in [
            ("orders", "o_totalprice"),
            ("lineitem", "l_quantity"),
            ("lineitem", "l_extendedprice"),
            ("lineitem", "l_discount"),
        ]
    ),
)
def profile_summary(t):
    parts = [
        profile.summarize(t.orders, ["o_totalprice"]),
        profile.summarize(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]),
    ]
    whole = parts[0].unionByName(parts[1])
    return whole.withColumns({c: F.round(c, 4) for c in ("mean", "stddev", "p25", "p50", "p75")})


@query(
    "histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin, count(*) AS ct
       FROM lineitem, s GROUP BY 1""",
)
def histogram(t):
    return profile.histogram(t.lineitem, "l_extendedprice", 20)


_BOX_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "boxplot_stats",
    f"""WITH long AS (
          {' UNION ALL '.join(f"SELECT l_returnflag, '{c}' AS column_name, {c} AS value FROM lineitem" for c in _BOX_COLUMNS)}),
        q AS (SELECT l_returnflag, column_name, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
                     quantile_cont(value, 0.75) AS p75 FROM long GROUP BY ALL),
        f AS (SELECT *, p25 - 1.5 * (p75 - p25) AS lo, p75 + 1.5 * (p75 - p25) AS hi FROM q)
        SELECT l_returnflag, column_name, round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75,
               min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low,
               max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
               count(*) FILTER (NOT value BETWEEN lo AND hi) AS outliers
        FROM long JOIN f USING (l_returnflag, column_name) GROUP BY l_returnflag, column_name, p25, p50, p75""",
)
def boxplot_stats(t):
    stats = profile.boxplot(t.lineitem, _BOX_COLUMNS, ["l_returnflag"])
    return stats.withColumns({c: F.round(c, 4) for c in profile.QUARTILES})


# ---- windows ---------------------------------------------------------------


@query(
    "event_date_id",
    """SELECT event_id, user_id, dayofweek(ts)::INTEGER + 1 AS start_dayofweek, dayofyear(ts)::INTEGER AS start_dayofyear,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS event_date_id FROM events""",
)
def event_date_id(t):
    days = t.events.select(
        "event_id",
        "user_id",
        "ts",
        F.dayofweek("ts").alias("start_dayofweek"),
        F.dayofyear("ts").alias("start_dayofyear"),
    ).dropDuplicates(["user_id", "ts", "event_id"])
    days = t.workspace().keep(days, "days")
    return numbered(days, ["user_id"], "ts", "event_id", "event_date_id").drop("ts")


@query(
    "event_date_id_desc",
    """SELECT event_id, user_id, event_type,
              row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id)::INTEGER AS event_date_id
       FROM events""",
)
def event_date_id_desc(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return numbered(rows, ["user_id", "event_type"], "ts", "event_id", "event_date_id", descending=True).drop("ts")


# ---- sort, limit, top-k, sets ----------------------------------------------


@query(
    "limit_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def limit_rows(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query(
    "top_referrers",
    """SELECT user_id AS referrer, event_id, value AS click_value FROM events
       WHERE event_type = 'click' ORDER BY value DESC, event_id LIMIT 10""",
)
def top_referrers(t):
    return (
        t.events.where("event_type = 'click'")
        .withColumnsRenamed({"user_id": "referrer", "value": "click_value"})
        .orderBy(F.desc("click_value"), "event_id")
        .select("referrer", "event_id", "click_value")
        .limit(10)
    )


@query(
    "latest_update",
    "SELECT event_id, user_id FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def latest_update(t):
    updates = t.events.where("event_type = 'signup'")
    return updates.agg(F.max(F.struct("ts", "event_id", "user_id")).alias("last")).select(
        "last.event_id", "last.user_id"
    )


@query(
    "union_all",
    """SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region
       UNION ALL SELECT s_nationkey, s_name FROM supplier""",
)
def union_all(t):
    nations = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return nations.union(t.region.select("r_regionkey", "r_name")).union(t.supplier.select("s_nationkey", "s_name"))


@query(
    "union_distinct",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    return customers.union(t.supplier.select("s_nationkey")).distinct()
