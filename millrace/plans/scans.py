"""Reader and writer queries. Inputs in other formats are first written from the parquet tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import sinks
from millrace.functions.dates import coerce_timestamp
from millrace.operators.nested import nest_lines
from millrace.operators.relational import null_counts
from millrace.plans.registry import query
from millrace.sources import files, generate, tables
from millrace.sources.copy_into import copy_into, read_copied

PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def _part_lines(t, bad: bool = True):
    """Every part as a CSV line; some brands get a line that breaks the schema."""
    line = F.concat_ws(",", "p_partkey", "p_size", "p_retailprice")
    if bad:
        line = (
            F.when(F.col("p_brand") == "Brand#1", F.concat(F.lit("x,0.7,"), F.col("p_retailprice")))
            .when(F.col("p_brand") == "Brand#2", F.concat_ws(",", "p_partkey", F.lit("abc"), "p_retailprice"))
            .when(F.col("p_brand") == "Brand#3", F.col("p_partkey").cast("string"))
            .otherwise(line)
        )
    return t.part.select(line.alias("value"))


def _write_part_lines(t, bad: bool = True) -> str:
    path = t.workspace().path("part_lines")
    sinks.write_files(_part_lines(t, bad), path, "text")
    return path


# ---- CSV -------------------------------------------------------------------


@query(
    "csv_infer_scan",
    """SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def csv_infer_scan(t):
    path = t.workspace().path("customer_csv")
    sinks.write_files(t.customer, path, "csv", header=True)
    return files.read_csv(t.spark, path)


@query("csv_schema_scan", "SELECT * FROM nation")
def csv_schema_scan(t):
    path = t.workspace().path("nation_csv")
    sinks.write_files(t.nation, path, "csv", header=True, sep=";")
    return files.read_csv(t.spark, path, "n_nationkey int, n_name string, n_regionkey int", sep=";")


@query(
    "csv_permissive",
    """SELECT CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_partkey END AS p_partkey,
              CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN NULL ELSE p_size END AS p_size,
              CASE WHEN p_brand = 'Brand#3' THEN NULL ELSE p_retailprice END AS p_retailprice FROM part""",
)
def csv_permissive(t):
    return files.read_csv(t.spark, _write_part_lines(t), PART_SCHEMA, header=False)


@query(
    "csv_dropmalformed",
    "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')",
)
def csv_dropmalformed(t):
    return files.read_csv(t.spark, _write_part_lines(t), PART_SCHEMA, header=False, mode="DROPMALFORMED")


@query("csv_failfast", "SELECT p_partkey, p_size, p_retailprice FROM part")
def csv_failfast(t):
    return files.read_csv(t.spark, _write_part_lines(t, bad=False), PART_SCHEMA, header=False, mode="FAILFAST")


@query(
    "csv_quarantine",
    """SELECT CASE p_brand WHEN 'Brand#1' THEN 'x' ELSE p_partkey::VARCHAR END AS first_field, count(*) AS ct
       FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1""",
)
def csv_quarantine(t):
    bad_path = t.workspace().path("bad")
    _, bad = files.split_bad_records(t.spark, _write_part_lines(t), PART_SCHEMA, bad_path)
    return bad.groupBy(F.substring_index("record", ",", 1).alias("first_field")).agg(F.count("*").alias("ct"))


@query(
    "csv_good_rows",
    """SELECT 'rows' AS what, count(*)::DOUBLE AS n FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')
       UNION ALL SELECT 'keys', sum(p_partkey)::DOUBLE FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')
       UNION ALL SELECT 'price', round(sum(p_retailprice), 2) FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3')""",
)
def csv_good_rows(t):
    """The good side, asked for no column, for one and for another."""
    good, _ = files.split_bad_records(t.spark, _write_part_lines(t), PART_SCHEMA, t.workspace().path("bad"))
    asked = {"rows": F.count("*"), "keys": F.sum("p_partkey"), "price": F.round(F.sum("p_retailprice"), 2)}
    parts = [good.agg(c.cast("double").alias("n")).select(F.lit(what).alias("what"), "n") for what, c in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- JSON ------------------------------------------------------------------


@query("json_scan", "SELECT event_id, user_id, event_type, value FROM events")
def json_scan(t):
    path = t.workspace().path("events_json")
    sinks.write_files(t.events, path, "json")
    return files.read_json(t.spark, path).select("event_id", "user_id", "event_type", "value")


@query("json_multiline_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def json_multiline_scan(t):
    path = t.workspace().path("customer_arrays")
    sinks.write_json_arrays(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return files.read_json(t.spark, path, multiline=True)


@query(
    "json_nested_scan",
    """SELECT o_orderkey, count(*)::INTEGER AS n_lines, round(sum(l_quantity), 2) AS qty
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def json_nested_scan(t):
    path = t.workspace().path("orders_json")
    documents = nest_lines(t.orders, t.lineitem)
    sinks.write_files(documents, path, "json")
    nested = files.read_json(t.spark, path, documents.schema).where("lines IS NOT NULL")
    quantity = F.aggregate("lines.quantity", F.lit(0.0), lambda a, b: a + b)
    return nested.groupBy("o_orderkey").agg(
        F.sum(F.size("lines")).cast("int").alias("n_lines"), F.round(F.sum(quantity), 2).alias("qty")
    )


@query(
    "json_string_ingest",
    "SELECT event_id, (props->>'k')::INTEGER AS k FROM events",
)
def json_string_ingest(t):
    return files.json_rows(t.events.select("event_id", "props"), "props", "k int").drop("props")


# ---- parquet, tables, paths ------------------------------------------------


@query("parquet_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def parquet_scan(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "file_path_sql",
    "SELECT l_shipdate::DATE AS day, count(*) AS ct FROM lineitem GROUP BY 1",
)
def file_path_sql(t):
    path = t.path("lineitem")
    return t.spark.sql(f"SELECT to_date(l_shipdate) AS day, count(*) AS ct FROM parquet.`{path}` GROUP BY 1")


@query("table_scan", "SELECT * FROM supplier")
def table_scan(t):
    name = t.workspace().table("supplier")
    sinks.save_table(t.supplier, name)
    return t.spark.read.table(name)


@query("external_csv_table", "SELECT c_mktsegment, count(*) AS ct FROM customer GROUP BY 1")
def external_csv_table(t):
    space = t.workspace()
    path = space.path("customer_csv")
    sinks.write_files(t.customer, path, "csv", header=True)
    table = tables.external_csv_table(t.spark, space.table("customer_ext"), path)
    return table.groupBy("c_mktsegment").agg(F.count("*").alias("ct"))


@query("location_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def location_table(t):
    space = t.workspace()
    path = space.path("orders")
    sinks.write_files(t.orders, path, "parquet")
    return tables.located_table(t.spark, space.table("orders"), path).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "copy_into",
    """SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def copy_into_query(t):
    space = t.workspace()
    target, landing = space.path("target"), space.path("landing")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    sinks.write_files(t.customer.where("c_acctbal < 0").select(columns), landing, "json")
    copy_into(t.spark, target, landing, "json", glob="*.json")
    copy_into(t.spark, target, landing, "json", glob="*.json")
    more = t.customer.where("c_acctbal >= 0").select(*columns, "c_mktsegment")
    sinks.write_files(more, landing, "json", mode="append")
    copy_into(t.spark, target, landing, "json", glob="*.json")
    return read_copied(t.spark, target)


@query(
    "copy_into_types",
    """SELECT c_custkey, CASE WHEN c_nationkey < 8 THEN c_nationkey::VARCHAR WHEN c_nationkey < 16 THEN 'N' || c_nationkey END AS code,
              CASE WHEN c_nationkey < 8 THEN c_nationkey::DOUBLE ELSE c_acctbal END AS amount,
              CASE WHEN c_nationkey >= 16 THEN c_name END AS home_name, (c_nationkey + CASE WHEN c_nationkey >= 16 THEN 0.5 ELSE 0 END)::DOUBLE AS home_key
       FROM customer""",
)
def copy_into_types(t):
    """Three loads whose types differ: numbers, then text, then a wider struct."""
    space = t.workspace()
    target, landing = space.path("target"), space.path("landing")
    key = F.col("c_nationkey")
    waves = [
        (key < 8, [key.alias("code"), key.alias("amount"), F.struct(key.alias("id")).alias("home")]),
        ((key >= 8) & (key < 16), [F.concat(F.lit("N"), key).alias("code"), F.col("c_acctbal").alias("amount"), F.struct(key.alias("id")).alias("home")]),
        (key >= 16, [F.col("c_acctbal").alias("amount"), F.struct((key + 0.5).alias("id"), F.col("c_name").alias("name")).alias("home")]),
    ]
    for where, columns in waves:
        sinks.write_files(t.customer.where(where).select("c_custkey", *columns), landing, "json", mode="append")
        copy_into(t.spark, target, landing, "json", glob="*.json")
    rows = read_copied(t.spark, target)
    return rows.select("c_custkey", "code", "amount", F.col("home.name").alias("home_name"), F.col("home.id").alias("home_key"))


@query(
    "binary_scan",
    """SELECT sum(octet_length(encode(html)) + 1)::BIGINT AS bytes_listed,
              sum(octet_length(encode(html)) + 1)::BIGINT AS bytes_read FROM pages""",
)
def binary_scan(t):
    path = t.workspace().path("pages_html")
    sinks.write_files(t.pages.select("html"), path, "text", maxRecordsPerFile=1000)
    listed = files.list_files(t.spark, path, "*.txt").agg(F.sum("length")).scalar()
    content = files.binary_files(t.spark, path, "*.txt")
    return content.agg(F.sum(F.octet_length("content")).alias("bytes_read")).select(
        listed.alias("bytes_listed"), "bytes_read"
    )


# ---- generated and coerced -------------------------------------------------


@query(
    "range_source",
    """SELECT o_orderkey IS NOT NULL AS present, count(*) AS ct
       FROM range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) + 10 FROM orders)) AS r(id)
       LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) ON o_orderkey = r.id GROUP BY 1""",
)
def range_source(t):
    ends = t.orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    ids = t.spark.range(ends.low, ends.high + 10)
    keys = t.orders.select("o_orderkey").distinct()
    return (
        ids.join(keys, F.col("id") == F.col("o_orderkey"), "left")
        .groupBy(F.col("o_orderkey").isNotNull().alias("present"))
        .agg(F.count("*").alias("ct"))
    )


@query(
    "synthetic_temps",
    """SELECT unit, count(*) AS ct, true AS mean_close, true AS spread_close
       FROM events, (VALUES ('F'), ('C')) AS u(unit) GROUP BY unit""",
)
def synthetic_temps(t):
    readings = generate.temperature_readings(t.events.select("event_id"))
    mean = F.when(F.col("unit") == "F", 55.0).otherwise(10.0)
    spread = F.when(F.col("unit") == "F", 25.0).otherwise(10.0)
    stats = readings.groupBy("unit").agg(
        F.count("*").alias("ct"), F.avg("temp").alias("_mean"), F.stddev_samp("temp").alias("_spread")
    )
    return stats.select(
        "unit",
        "ct",
        (F.abs(F.col("_mean") - mean) < 8 * spread / F.sqrt("ct")).alias("mean_close"),
        (F.abs(F.col("_spread") - spread) < 8 * spread / F.sqrt("ct")).alias("spread_close"),
    )


@query(
    "coerce_dates",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts::DATE END AS day,
              CASE WHEN event_type = 'view' THEN NULL ELSE (props->>'k')::INTEGER END AS k FROM events""",
)
def coerce_dates(t):
    text = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("ts").cast("string")))
        .otherwise(F.col("ts").cast("string"))
        .alias("ts"),
        F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.get_json_object("props", "$.k")).alias("k"),
    )
    return text.select(
        "event_id", F.to_date(coerce_timestamp("ts")).alias("day"), F.col("k").try_cast("int").alias("k")
    )


# ---- sinks -----------------------------------------------------------------


@query("save_table", "SELECT c_custkey, c_name FROM customer")
def save_table(t):
    name = t.workspace().table("saved")
    sinks.save_table(t.customer.select("c_custkey", "c_name"), name)
    return t.spark.sql(f"SELECT * FROM {name}")


@query("overwrite_schema", "SELECT s_suppkey, s_name, upper(s_name) AS upp_name FROM supplier")
def overwrite_schema(t):
    name = t.workspace().table("supplier_names")
    first = t.supplier.select("s_suppkey", "s_name")
    sinks.save_table(first, name)
    sinks.save_table(first.withColumn("upp_name", F.upper("s_name")), name)
    return t.spark.table(name)


@query("json_sink", "SELECT * FROM part")
def json_sink(t):
    path = t.workspace().path("part_json")
    sinks.write_files(t.part, path, "json")
    return files.read_json(t.spark, path, t.part.schema)


@query("csv_sink", "SELECT * FROM part")
def csv_sink(t):
    path = t.workspace().path("part_csv")
    sinks.write_files(t.part, path, "csv", header=True)
    return files.read_csv(t.spark, path, t.part.schema)


@query(
    "partitioned_write",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS o_month FROM orders
       WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'""",
)
def partitioned_write(t):
    path = t.workspace().path("orders_by_month")
    monthly = t.orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("o_month"))
    sinks.write_partitioned(monthly, path, ["o_month"])
    return t.spark.read.parquet(path).where("o_month = '1997-03'")


@query(
    "insert_append",
    "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def insert_append(t):
    name = t.workspace().table("names")
    sinks.save_table(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), name)
    t.spark.sql(f"INSERT INTO {name} SELECT s_suppkey, s_name FROM {{supplier}}", supplier=t.supplier)
    return t.spark.table(name)


@query(
    "ctas",
    """SELECT year(o_orderdate)::INTEGER AS year, count(*) AS ct FROM orders
       WHERE year(o_orderdate) = 1997 GROUP BY 1""",
)
def ctas(t):
    name = t.workspace().table("orders_1997")
    t.spark.sql(
        f"CREATE TABLE {name} USING parquet AS "
        "SELECT *, year(o_orderdate) AS year FROM {orders} WHERE year(o_orderdate) = 1997",
        orders=t.orders,
    )
    return t.spark.table(name).groupBy("year").agg(F.count("*").alias("ct"))


@query(
    "describe_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, '{kind}' AS data_type, count(*) - count({c}) AS nulls FROM orders"
        for c, kind in [
            ("o_orderkey", "bigint"),
            ("o_custkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"),
        ]
    ),
)
def describe_columns(t):
    space = t.workspace()
    tables.located_table(t.spark, space.table("orders"), t.path("orders"))
    described = tables.describe(t.spark, space.table("orders"))
    nulls = null_counts(t.spark.table(space.table("orders"))).withColumnRenamed("column_name", "col_name")
    return described.join(nulls, "col_name")
