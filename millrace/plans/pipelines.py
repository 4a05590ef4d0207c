"""Data-quality, pipeline-log and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import sinks
from millrace.functions.text import json_path
from millrace.operators import pipeline_log
from millrace.operators.nested import nest_lines
from millrace.operators.quality import DROP, FAIL, WARN, Rule, enforce, enforce_and_measure, measure
from millrace.plans.registry import query
from millrace.streaming import ingest, medallion

# ---- expectations ----------------------------------------------------------

_POSITIVE = Rule("valid_value", "value > 50", WARN)


def _counts(rule: str, policy: str, dataset: str, table: str, condition: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{rule}' AS name, '{policy}' AS policy,
                      count(*) FILTER (coalesce({condition}, false)) AS passed_records,
                      count(*) FILTER (NOT coalesce({condition}, false)) AS failed_records FROM {table}"""


@query("expect_warn", _counts("valid_value", "warn", "events", "events", "value > 50"))
def expect_warn(t):
    return measure(t.events, "events", [_POSITIVE])


_LINE_RULES = [
    Rule("small_discount", "l_discount <= 0.05", DROP),
    Rule("some_quantity", "l_quantity > 2", DROP),
    Rule("taxed", "l_tax > 0", WARN),
]


@query(
    "expect_drop",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0.05 AND l_quantity > 2",
)
def expect_drop(t):
    return enforce(t.lineitem, _LINE_RULES).select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "expect_rows_and_counts",
    """SELECT l_orderkey, l_linenumber, (SELECT count(*) FROM lineitem WHERE NOT coalesce(l_discount <= 0.05, false)) AS small_discount,
              (SELECT count(*) FROM lineitem WHERE NOT coalesce(l_quantity > 2, false)) AS some_quantity,
              (SELECT count(*) FROM lineitem WHERE NOT coalesce(l_tax > 0, false)) AS taxed
       FROM lineitem WHERE l_discount <= 0.05 AND l_quantity > 2""",
)
def expect_rows_and_counts(t):
    """The cleaned rows, each with the failed counts of all rules, from one pass over the table."""
    clean, counts = enforce_and_measure(t.lineitem, "lineitem", _LINE_RULES, t.workspace())
    failed = {r.name: F.max(F.when(F.col("name") == r.name, F.col("failed_records"))) for r in _LINE_RULES}
    return clean.select("l_orderkey", "l_linenumber", *[counts.agg(c).scalar().alias(n) for n, c in failed.items()])


@query("expect_fail", "SELECT event_id, value FROM events")
def expect_fail(t):
    rules = [Rule("has_id", "event_id IS NOT NULL", FAIL), Rule("not_negative", "value >= 0", FAIL)]
    return enforce(t.events, rules).select("event_id", "value")


def _clickstream(t):
    return t.events.select(
        F.col("event_type").alias("curr_title"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("prev_title"),
        json_path("props", "k").alias("n"),
    )


@query(
    "clickstream_prepared",
    """SELECT event_type AS current_page_title, (props->>'k')::INTEGER AS click_count,
              'user_' || user_id AS previous_page_title FROM events""",
)
def clickstream_prepared(t):
    cleaned = (
        _clickstream(t)
        .withColumn("click_count", F.col("n").try_cast("int"))
        .withColumnsRenamed({"curr_title": "current_page_title", "prev_title": "previous_page_title"})
        .select("current_page_title", "click_count", "previous_page_title")
    )
    rules = [
        Rule("valid_current_page_title", "current_page_title IS NOT NULL", FAIL),
        Rule("valid_count", "click_count >= 0", FAIL),
    ]
    return enforce(cleaned, rules)


# ---- pipeline log ----------------------------------------------------------


@query(
    "expectation_report",
    """SELECT 'events' AS dataset, 'valid_value' AS expectation, count(*) FILTER (value > 50) AS passing_records,
              count(*) FILTER (value <= 50) AS failing_records FROM events
       UNION ALL SELECT 'events', 'has_user', count(user_id), count(*) - count(user_id) FROM events
       UNION ALL SELECT 'lineitem', 'small_discount', count(*) FILTER (l_discount <= 0.05),
              count(*) FILTER (l_discount > 0.05) FROM lineitem""",
)
def expectation_report(t):
    metrics = measure(t.events, "events", [_POSITIVE, Rule("has_user", "user_id IS NOT NULL")]).unionByName(
        measure(t.lineitem, "lineitem", [Rule("small_discount", "l_discount <= 0.05", DROP)])
    )
    at = F.lit("2024-01-31 00:00:00").cast("timestamp")
    log = pipeline_log.quality_events(metrics, "update-1", at)
    return pipeline_log.expectation_report(pipeline_log.of_update(log, "update-1"))


def _log(t):
    """Events as a pipeline log: the event type decides what an entry reports."""
    user = F.concat(F.lit("user_"), F.col("user_id"))
    k = json_path("props", "k").cast("int")
    action = F.struct(F.struct(F.col("event_type").alias("action"), user.alias("user_name")).alias("user_action"))
    flow = F.struct(
        F.struct(
            F.concat(F.lit("table_"), k % 10).alias("output_dataset"),
            F.array(user, F.concat(F.lit("table_"), k % 7)).alias("input_datasets"),
        ).alias("flow_definition")
    )
    status = F.when(k < 30, "RESIZING").when(k < 60, "SUCCEEDED").when(k < 80, "PARTIALLY_SUCCEEDED").otherwise("FAILED")
    scale = F.struct(F.struct(status.alias("status"), F.col("value").alias("requested_num_executors")).alias("autoscale"))
    kind = (
        F.when(F.col("event_type").isin("click", "signup"), "user_action")
        .when(F.col("event_type") == "view", "flow_definition")
        .when(F.col("event_type") == "purchase", "autoscale")
        .otherwise("create_update")
    )
    return t.events.select(
        F.col("ts").alias("timestamp"),
        kind.alias("event_type"),
        F.concat(F.lit("update-"), F.col("user_id")).alias("update_id"),
        F.when(kind == "user_action", F.to_json(action))
        .when(kind == "flow_definition", F.to_json(flow))
        .when(kind == "autoscale", F.to_json(scale))
        .alias("details"),
    )


@query(
    "audit_log",
    """SELECT event_type AS action, 'user_' || user_id AS user_name, 'update-' || user_id AS update_id,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events WHERE event_type IN ('click', 'signup')""",
)
def audit_log(t):
    entries = pipeline_log.audit(_log(t)).orderBy(F.desc("timestamp"), "update_id")
    return entries.select("action", "user_name", "update_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "audit_log_latest",
    """WITH last AS (SELECT user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, user_id DESC LIMIT 1)
       SELECT event_type AS action, 'user_' || user_id AS user_name, 'update-' || user_id AS update_id, count(*) AS ct
       FROM events WHERE event_type IN ('click', 'signup') AND user_id = (SELECT user_id FROM last) GROUP BY ALL""",
)
def audit_log_latest(t):
    log = _log(t)
    current = pipeline_log.of_update(log, pipeline_log.latest_update_id(log))
    return pipeline_log.audit(current).groupBy("action", "user_name", "update_id").agg(F.count("*").alias("ct"))


@query(
    "lineage_edges",
    """WITH v AS (SELECT 'user_' || user_id AS u, (props->>'k')::INTEGER AS k FROM events WHERE event_type = 'view')
       SELECT DISTINCT 'table_' || (k % 10) AS output_dataset, u AS input_dataset FROM v
       UNION SELECT 'table_' || (k % 10), 'table_' || (k % 7) FROM v""",
)
def lineage_edges(t):
    return pipeline_log.lineage(_log(t))


_STATUSES = {
    "RESIZING": "starting_num_executors",
    "SUCCEEDED": "succeeded_num_executors",
    "PARTIALLY_SUCCEEDED": "partially_succeeded_num_executors",
    "FAILED": "failed_num_executors",
}


@query(
    "status_columns",
    """WITH p AS (SELECT ts, value, (props->>'k')::INTEGER AS k FROM events WHERE event_type = 'purchase')
       SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
              CASE WHEN k < 30 THEN value END AS starting_num_executors,
              CASE WHEN k BETWEEN 30 AND 59 THEN value END AS succeeded_num_executors,
              CASE WHEN k BETWEEN 60 AND 79 THEN value END AS partially_succeeded_num_executors,
              CASE WHEN k >= 80 THEN value END AS failed_num_executors FROM p""",
)
def status_columns(t):
    timeline = pipeline_log.status_columns(_log(t), _STATUSES)
    return timeline.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"), *_STATUSES.values())


# ---- streams ---------------------------------------------------------------

_EVENTS = "SELECT event_id, event_type, value FROM events"


def _ingested(t, sink: str):
    payload = F.from_json("payload", "event_id bigint, event_type string, value double").alias("e")
    return t.spark.read.parquet(sink).select(payload).select("e.*")


@query("stream_ingest", _EVENTS)
def stream_ingest(t):
    space = t.workspace()
    ingest.send(ingest.to_messages(t.events, "event_id", "ts"), space.path("landing"))
    stream = ingest.read_messages(t.spark, space.path("landing"), start_offset=0)
    ingest.append(stream, space.path("sink"), space.path("checkpoint"))
    return _ingested(t, space.path("sink"))


@query("stream_restart", _EVENTS)
def stream_restart(t):
    space = t.workspace()
    first = F.col("event_type").isin("click", "view")
    for part in (t.events.where(first), t.events.where(~first)):
        ingest.send(ingest.to_messages(part, "event_id", "ts"), space.path("landing"))
        stream = ingest.read_messages(t.spark, space.path("landing"))
        ingest.append(stream, space.path("sink"), space.path("checkpoint"))
    return _ingested(t, space.path("sink"))


@query("stream_file_json", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def stream_file_json(t):
    space = t.workspace()
    sinks.write_files(t.orders, space.path("landing"), "json")
    stream = ingest.read_new_files(t.spark, space.path("landing"), "json", t.orders.schema)
    ingest.append(stream, space.path("sink"), space.path("checkpoint"))
    return t.spark.read.parquet(space.path("sink")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("stream_file_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def stream_file_csv(t):
    """Customers that arrive as CSV files, in two batches, as a table."""
    space = t.workspace()
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    customers = t.customer.select(columns)
    for part in (F.col("c_acctbal") < 0, F.coalesce(F.col("c_acctbal") >= 0, F.lit(True))):
        sinks.write_files(customers.where(part), space.path("landing"), "csv", mode="append", header=True)
        stream = ingest.read_new_files(t.spark, space.path("landing"), "csv", customers.schema, header=True)
        ingest.append(stream, space.path("sink"), space.path("checkpoint"))
    return t.spark.read.parquet(space.path("sink")).select(columns)


def _customers(t):
    cities = t.nation.select("n_nationkey", F.col("n_name").alias("city"))
    return t.customer.join(cities, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        "city",
        F.col("c_mktsegment").alias("loyalty_segment"),
    )


@query(
    "stream_static_join",
    """SELECT o_orderkey AS order_number, o_custkey AS customer_id, c_mktsegment AS loyalty_segment
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey
            AND c_name = 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0')""",
)
def stream_static_join(t):
    space = t.workspace()
    raw = t.orders.select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.format_string("Customer#%09d", "o_custkey").alias("customer_name"),
    )
    sinks.write_files(raw, space.path("landing"), "json")
    stream = ingest.read_new_files(t.spark, space.path("landing"), "json", raw.schema)
    joined = stream.join(_customers(t), ["customer_id", "customer_name"], "left")
    ingest.append(joined, space.path("sink"), space.path("checkpoint"))
    return t.spark.read.parquet(space.path("sink")).select("order_number", "customer_id", "loyalty_segment")


@query(
    "medallion_sales",
    """SELECT n_name AS city, o_orderdate::DATE AS order_date, c_custkey AS customer_id, c_name AS customer_name,
              l_returnflag AS curr, round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity), 2) AS quantity,
              count(l_partkey) AS product_count
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus <> 'P' GROUP BY ALL""",
)
def medallion_sales(t):
    return _rounded_sales(medallion.sales_by_city(_silver(t, "order_month")))


@query(
    "medallion_cities",
    """SELECT n_name AS city, o_orderdate::DATE AS order_date, c_custkey AS customer_id, c_name AS customer_name,
              l_returnflag AS curr, round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity), 2) AS quantity,
              count(l_partkey) AS product_count
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus <> 'P' AND n_name IN ('NATION_3', 'NATION_7') GROUP BY ALL""",
)
def medallion_cities(t):
    """One gold table per city, both from one silver table stored by day."""
    silver = _silver(t, "order_date")
    third, seventh = (medallion.sales_by_city(silver, city) for city in ("NATION_3", "NATION_7"))
    return _rounded_sales(third.unionByName(seventh))


@query(
    "medallion_incremental",
    """SELECT n_name AS city, o_orderdate::DATE AS order_date, c_custkey AS customer_id, c_name AS customer_name,
              l_returnflag AS curr, round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity), 2) AS quantity,
              count(l_partkey) AS product_count
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus <> 'P' GROUP BY ALL""",
)
def medallion_incremental(t):
    """Gold brought up to date after each of three waves of orders, only for the months that a wave touches."""
    space = t.workspace()
    raw = space.keep(_raw_orders(t), "raw")
    for wave in _waves(F.col("priority")):
        sinks.write_files(raw.where(wave).drop("priority"), space.path("bronze"), "json", mode="append")
        bronze = ingest.read_new_files(t.spark, space.path("bronze"), "json", raw.drop("priority").schema)
        silver = medallion.cleaned_orders(bronze, _customers(t))
        ingest.append(silver, space.path("silver"), space.path("silver-checkpoint"), ["order_month"])
        new = ingest.read_new_files(t.spark, space.path("silver"), "parquet", silver.schema)
        ingest.keep_current(new, space.path("silver"), "order_month", medallion.monthly_sales, space.path("gold"), space.path("gold-checkpoint"))
    return _rounded_sales(t.spark.read.parquet(space.path("gold")).drop("order_month"))


def _waves(priority):
    """Three conditions of which each row meets one."""
    first = F.coalesce(priority.isin("1-URGENT", "2-HIGH"), F.lit(False))
    second = F.coalesce(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit(False))
    return [first, second, ~first & ~second]


@query(
    "stream_rescued",
    """WITH waves AS (
           SELECT *, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
                          WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 2 ELSE 3 END AS wave FROM orders
       )
       SELECT o_orderkey, CASE WHEN wave = 1 OR o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
              CASE WHEN wave > 1 THEN o_orderstatus END AS o_orderstatus, CASE WHEN wave = 3 THEN o_custkey END AS o_custkey,
              CASE WHEN wave > 1 AND o_orderstatus = 'F' THEN 'price of ' || o_orderkey END AS rescued_price
       FROM waves""",
)
def stream_rescued(t):
    """Orders in three waves of files: columns appear in the second and third, and some prices are no numbers."""
    space = t.workspace()
    word = F.concat(F.lit("price of "), F.col("o_orderkey").cast("string"))
    price = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('"'), word, F.lit('"'))).otherwise(F.col("o_totalprice").cast("string"))
    fields = {"o_orderkey": F.col("o_orderkey").cast("string"), "o_totalprice": F.col("o_totalprice").cast("string")}
    later = {**fields, "o_totalprice": price, "o_orderstatus": F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))}
    last = {**later, "o_custkey": F.col("o_custkey").cast("string")}
    for wave, columns in zip(_waves(F.col("o_orderpriority")), (fields, later, last), strict=True):
        named = [F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))) for name, value in columns.items()]
        line = F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))
        t.orders.where(wave).select(line.alias("value")).write.mode("append").text(space.path("landing"))
        stream = ingest.read_rescuing(t.spark, space.path("landing"), space.path("schema"))
        ingest.append(stream, space.path("sink"), space.path("checkpoint"))
    rows = t.spark.read.option("mergeSchema", True).parquet(space.path("sink"))
    return rows.select(*last, F.element_at("_rescued", "o_totalprice").alias("rescued_price"))


def _rounded_sales(gold):
    return gold.withColumns({"sales": F.round("sales", 2), "quantity": F.round("quantity", 2)})


def _raw_orders(t):
    """Orders with their lines nested, as they arrive, and their priority."""
    product = F.transform(
        "lines",
        lambda x: F.struct(
            x["part"].alias("id"), x["flag"].alias("curr"), x["price"].alias("price"), x["quantity"].alias("qty")
        ),
    )
    # Pending orders arrive without a number, so the cleaned layer drops them.
    return nest_lines(t.orders, t.lineitem).select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.format_string("Customer#%09d", "o_custkey").alias("customer_name"),
        F.unix_timestamp("o_orderdate").cast("string").alias("order_datetime"),
        product.alias("ordered_products"),
        F.col("o_orderpriority").alias("priority"),
    )


def _silver(t, folder: str):
    """Orders through the raw and the cleaned layer, the latter stored by day or by month."""
    space = t.workspace()
    raw = _raw_orders(t).drop("priority")
    sinks.write_files(raw, space.path("bronze"), "json")
    bronze = ingest.read_new_files(t.spark, space.path("bronze"), "json", raw.schema)
    silver = medallion.cleaned_orders(bronze, _customers(t))
    ingest.append(silver, space.path("silver"), space.path("checkpoint"), [folder])
    return t.spark.read.parquet(space.path("silver"))


@query(
    "stream_tumbling",
    """SELECT event_type, strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS ct
       FROM events WHERE time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE
                         <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
       GROUP BY ALL""",
)
def stream_tumbling(t):
    space = t.workspace()
    rows = t.events.select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    sinks.write_files(rows, space.path("landing"), "parquet")
    stream = ingest.read_new_files(t.spark, space.path("landing"), "parquet", rows.schema)
    counts = ingest.window_counts(stream, "ts", "event_type", "30 minutes", "10 minutes")
    ingest.append(counts, space.path("sink"), space.path("checkpoint"))
    return t.spark.read.parquet(space.path("sink")).select(
        "event_type", F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "ct"
    )
