"""Queries over nested documents, scalar functions and UDF surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, text, udfs, units, vectorised
from millrace.functions import tables as table_functions
from millrace.operators import nested
from millrace.plans.registry import query


def _documents(t):
    return nested.nest_lines(t.orders, t.lineitem)


# ---- nested ----------------------------------------------------------------


@query(
    "nested_flatten",
    """SELECT o_orderkey, l_linenumber AS number, l_partkey AS part, l_quantity AS quantity,
              l_extendedprice AS price, l_returnflag AS flag, l_shipdate::DATE AS shipped
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def nested_flatten(t):
    return nested.explode_struct(_documents(t).select("o_orderkey", "lines"), "lines")


@query(
    "array_field_project",
    """SELECT o_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def array_field_project(t):
    projected = _documents(t).select("o_orderkey", F.col("lines.part").alias("parts"))
    return projected.where("parts IS NOT NULL").select(
        "o_orderkey", F.array_join(F.col("parts").cast("array<string>"), ",").alias("parts")
    )


@query(
    "multi_explode",
    """WITH d AS (SELECT o_orderkey, l_linenumber, unnest(string_split(o_orderpriority, '-')) AS word
                  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
       SELECT word, l_linenumber AS number, count(*) AS ct FROM d GROUP BY ALL""",
)
def multi_explode(t):
    exploded = nested.explode_all(_documents(t), {"line": "lines", "word": F.split("o_orderpriority", "-")})
    return exploded.groupBy("word", F.col("line.number").alias("number")).agg(F.count("*").alias("ct"))


@query(
    "category_counts",
    "SELECT l_returnflag AS category_name, count(*) AS ct FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
)
def category_counts(t):
    categories = _documents(t).select(F.explode("lines.flag").alias("category_name"))
    return categories.groupBy("category_name").agg(F.count("*").alias("ct")).orderBy(F.desc("ct"), "category_name")


@query(
    "flag_sum_by_category",
    """SELECT l_returnflag AS category, sum(is_open)::BIGINT AS sum_open FROM (
         SELECT DISTINCT o_orderkey, l_returnflag, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_open
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def flag_sum_by_category(t):
    exploded = _documents(t).select("o_orderkey", "o_orderstatus", F.explode("lines.flag").alias("category"))
    return nested.flag_sum_by(exploded, ["o_orderkey"], "category", F.col("o_orderstatus") == "O", "sum_open")


@query(
    "exploded_sales",
    """SELECT n_name AS city, o_orderdate::DATE AS order_date, c_custkey, c_name, l_returnflag AS curr,
              round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity), 2) AS quantity, count(l_partkey) AS product_count
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN orders ON o_custkey = c_custkey
       JOIN lineitem ON l_orderkey = o_orderkey WHERE n_name = 'NATION_3' GROUP BY ALL""",
)
def exploded_sales(t):
    city = t.nation.where("n_name = 'NATION_3'")
    customers = t.customer.join(city, F.col("c_nationkey") == F.col("n_nationkey"))
    # The city's orders first, so only their lines are nested.
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lineitem = t.lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    sold = nested.nest_lines(orders, lineitem)
    lines = sold.select(
        F.col("n_name").alias("city"),
        F.to_date("o_orderdate").alias("order_date"),
        "c_custkey",
        "c_name",
        F.explode("lines").alias("line"),
    )
    return lines.groupBy("city", "order_date", "c_custkey", "c_name", F.col("line.flag").alias("curr")).agg(
        F.round(F.sum("line.price"), 2).alias("sales"),
        F.round(F.sum("line.quantity"), 2).alias("quantity"),
        F.count("line.part").alias("product_count"),
    )


@query(
    "report_view",
    """SELECT ts::DATE AS start_date, dayofweek(ts)::INTEGER + 1 AS start_dayofweek, event_type AS category,
              count(*) AS ct FROM events GROUP BY ALL""",
)
def report_view(t):
    text_dates = t.events.select(F.date_format("ts", "yyyy-M-d").alias("start_text"), "event_type")
    text_dates.createOrReplaceTempView("millrace_event_dates")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY VIEW millrace_event_report AS
           SELECT to_date(start_text, 'y-M-d') AS start_date, event_type AS category FROM millrace_event_dates"""
    )
    return t.spark.sql(
        """SELECT start_date, dayofweek(start_date) AS start_dayofweek, category, count(*) AS ct
           FROM millrace_event_report GROUP BY ALL"""
    )


# ---- scalar functions ------------------------------------------------------


@query(
    "date_parts",
    """SELECT o_orderkey, dayofweek(o_orderdate)::INTEGER + 1 AS weekday, dayofyear(o_orderdate)::INTEGER AS yearday,
              year(o_orderdate)::INTEGER AS year, date_trunc('month', o_orderdate)::DATE AS month,
              strftime(o_orderdate, '%a') AS dayname FROM orders""",
)
def date_parts(t):
    return t.orders.select(
        "o_orderkey",
        F.dayofweek("o_orderdate").alias("weekday"),
        F.dayofyear("o_orderdate").alias("yearday"),
        F.year("o_orderdate").alias("year"),
        F.trunc("o_orderdate", "MM").alias("month"),
        F.date_format("o_orderdate", "E").alias("dayname"),
    )


@query(
    "shift_year",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 365 DAY, '%Y-%m-%d') || 'T00:00:00' AS start_text,
              (o_orderdate + INTERVAL 365 DAY)::DATE AS start_date FROM orders""",
)
def shift_year(t):
    iso = t.orders.select(
        "o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("start_text")
    )
    return iso.select(
        "o_orderkey",
        dates.shift_days("start_text", 365).alias("start_text"),
        F.date_add(F.to_date("o_orderdate"), 365).alias("start_date"),
    )


@query(
    "epoch_to_ts",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS event_time, ts::DATE AS event_date
       FROM events""",
)
def epoch_to_ts(t):
    epochs = t.events.select("event_id", F.unix_timestamp("ts").cast("string").alias("epoch_text"))
    stamp = dates.epoch_to_timestamp("epoch_text")
    return epochs.select(
        "event_id",
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.to_date(stamp).alias("event_date"),
    )


@query(
    "is_weekend",
    """SELECT event_id, (dayofweek((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') IN (0, 6))::INTEGER
              AS weekend FROM events""",
)
def is_weekend(t):
    return t.events.select("event_id", dates.is_weekend("ts").alias("weekend"))


@query(
    "round_up_minutes",
    """SELECT event_id, ceil(epoch_us(ts) / (15 * 60 * 1e6))::BIGINT * 900 AS rounded_15,
              ceil(epoch_us(ts) / (30 * 60 * 1e6))::BIGINT * 1800 AS rounded_30 FROM events""",
)
def round_up_minutes(t):
    return t.events.select(
        "event_id", dates.round_up("ts", 15).alias("rounded_15"), dates.round_up("ts", 30).alias("rounded_30")
    )


@query(
    "cast_types",
    """SELECT l_orderkey, l_linenumber, l_quantity::INTEGER AS qty, l_shipdate::DATE AS day,
              l_orderkey::DOUBLE AS key_double, l_partkey::VARCHAR AS part_text, NULL::INTEGER AS bad FROM lineitem""",
)
def cast_types(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_orderkey").cast("double").alias("key_double"),
        F.col("l_partkey").cast("string").alias("part_text"),
        F.col("l_returnflag").try_cast("int").alias("bad"),
    )


@query("json_path", "SELECT event_id, (props->>'k')::INTEGER AS k FROM events WHERE (props->>'k')::INTEGER >= 50")
def json_path(t):
    k = text.json_path("props", "k").cast("int")
    return t.events.select("event_id", k.alias("k")).where("k >= 50")


@query(
    "event_bodies",
    """SELECT event_id, event_type AS data_type, value AS data_value FROM events""",
)
def event_bodies(t):
    bodies = t.events.select(F.encode(F.to_json(F.struct("event_id", "event_type", "value")), "UTF-8").alias("body"))
    decoded = bodies.select(text.body_text().alias("payload"))
    return decoded.select(
        text.json_path("payload", "event_id").cast("bigint").alias("event_id"),
        text.json_path("payload", "event_type").alias("data_type"),
        text.json_path("payload", "value").cast("double").alias("data_value"),
    )


# ---- UDF surfaces ----------------------------------------------------------

_CELSIUS = """SELECT event_id, round(CASE WHEN event_type IN ('click', 'view') THEN (value - 32) * 5 / 9
                                          ELSE value END, 4) AS c_temp FROM events"""


def _readings(t):
    unit = F.when(F.col("event_type").isin("click", "view"), "F").otherwise("C")
    return t.events.select("event_id", unit.alias("unit"), F.col("value").alias("temp"))


@query("f_to_c_expr", _CELSIUS)
def f_to_c_expr(t):
    celsius = units.to_celsius(F.col("unit"), F.col("temp"))
    return _readings(t).select("event_id", F.round(celsius, 4).alias("c_temp"))


@query("f_to_c_sql", _CELSIUS)
def f_to_c_sql(t):
    units.register_to_celsius(t.spark, "millrace_to_celsius")
    return t.spark.sql(
        "SELECT event_id, round(millrace_to_celsius(unit, temp), 4) AS c_temp FROM {readings}", readings=_readings(t)
    )


@query(
    "udf_equivalence",
    "SELECT count(*) AS ct, 0::BIGINT AS weekend_differs, 0::BIGINT AS month_differs, 0::BIGINT AS rounded_differs FROM events",
)
def udf_equivalence(t):
    both = t.events.select(
        (dates.is_weekend("ts") != udfs.is_weekend_udf()("ts")).alias("weekend"),
        (dates.year_month("ts") != udfs.year_month_udf()("ts")).alias("month"),
        (dates.round_up("ts", 15) != udfs.round_up_udf(15)("ts")).alias("rounded"),
    )
    return both.agg(
        F.count("*").alias("ct"),
        F.count_if("weekend").alias("weekend_differs"),
        F.count_if("month").alias("month_differs"),
        F.count_if("rounded").alias("rounded_differs"),
    )


@query("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents")
def strip_accents(t):
    plain = vectorised.strip_accents()
    return t.documents.select("doc_id", F.md5(plain("text").cast("binary")).alias("digest"))


@query(
    "name_similarity",
    """SELECT s_name, n_name, round(jaro_winkler_similarity(lower(s_name || ' ' || n_name), lower(n_name || ' ' || r_name)), 9) AS similarity
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def name_similarity(t):
    similarity = vectorised.name_similarity()
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    a, b = F.lower(F.concat_ws(" ", "s_name", "n_name")), F.lower(F.concat_ws(" ", "n_name", "r_name"))
    return rows.select("s_name", "n_name", F.round(similarity(a, b), 9).alias("similarity"))


@query(
    "sql_udtf",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 20""",
)
def sql_udtf(t):
    t.spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION millrace_lines(flag STRING, least DOUBLE)
           RETURNS TABLE (l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE)
           RETURN SELECT l_orderkey, l_linenumber, l_quantity FROM {t.view("lineitem")}
                  WHERE l_returnflag = flag AND l_quantity >= least"""
    )
    return t.spark.sql("SELECT * FROM millrace_lines('R', 20)")


@query(
    "python_udtf",
    """WITH timed AS (
           SELECT user_id AS key, ts::DATE AS day, ts,
                  coalesce(ts - lag(ts) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts) > INTERVAL 120 MINUTE, true) AS fresh
           FROM events WHERE ts IS NOT NULL
       ),
       numbered AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY key, day ORDER BY ts RANGE UNBOUNDED PRECEDING) AS visit FROM timed)
       SELECT key, day, visit::INT AS visit, floor(epoch(min(ts)))::BIGINT AS started, floor(epoch(max(ts)))::BIGINT AS ended, count(*) AS n_events
       FROM numbered GROUP BY key, day, visit""",
)
def python_udtf(t):
    """Visits of each user and day by a Python table function over a partitioned table argument."""
    t.spark.udtf.register("millrace_visits", table_functions.visits(120))
    rows = t.events.select(F.col("user_id").cast("bigint").alias("key"), F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"))
    found = t.spark.sql("SELECT * FROM millrace_visits(TABLE({rows}) PARTITION BY (key, day) ORDER BY ts)", rows=rows)
    return found.withColumns({"started": F.unix_seconds("started"), "ended": F.unix_seconds("ended")})
