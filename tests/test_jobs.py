"""Functions, quality rules, features, forecasts, classification, streams, documents."""

import datetime as dt
import html

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, text, units
from millrace.operators import classify, documents, features, forecast, nested, pipeline_log, profile, quality
from millrace.operators.quality import DROP, FAIL, WARN, Rule
from millrace.streaming import ingest, medallion


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# ---- functions -------------------------------------------------------------


@pytest.mark.parametrize(
    "moment, up, down",
    [
        ("2024-01-01 10:00:00", "10:00", "10:00"),
        ("2024-01-01 10:00:00.000001", "10:15", "10:00"),
        ("2024-01-01 10:14:59.999999", "10:15", "10:00"),
        ("2023-12-31 23:59:00", "00:00", "23:45"),
    ],
)
def test_rounding_to_quarter_hours(spark, moment, up, down):
    ts = F.lit(moment).cast("timestamp_ntz")
    assert one(spark, F.date_format(F.timestamp_seconds(dates.round_up(ts, 15)), "HH:mm")) == up
    assert one(spark, F.date_format(F.timestamp_seconds(dates.round_down(ts, 15)), "HH:mm")) == down


@pytest.mark.parametrize(
    "moment, zone, expected",
    [
        ("2024-01-06 04:59:59", "America/New_York", 0),
        ("2024-01-06 05:00:00", "America/New_York", 1),
        ("2024-01-08 04:59:59", "America/New_York", 1),
        ("2024-01-08 05:00:00", "America/New_York", 0),
        ("2024-01-06 00:00:00", "UTC", 1),
    ],
)
def test_weekend_depends_on_the_zone(spark, moment, zone, expected):
    assert one(spark, dates.is_weekend(F.lit(moment).cast("timestamp_ntz"), zone)) == expected


def test_text_times(spark):
    assert one(spark, dates.shift_days(F.lit("2024-01-02T10:00:00"), 365)) == "2025-01-01T10:00:00"
    assert one(spark, dates.coerce_timestamp(F.lit("nonsense"))) is None
    assert one(spark, dates.epoch_to_timestamp(F.lit("x"))) is None
    assert one(spark, dates.epoch_to_timestamp(F.lit("86400"))) == dt.datetime(1970, 1, 2)
    assert one(spark, dates.year_month(F.lit("2024-03-09").cast("date"))) == "2024-03"


def test_celsius(spark):
    assert one(spark, units.to_celsius(F.lit("F"), F.lit(212.0))) == pytest.approx(100.0)
    units.register_to_celsius(spark, "test_to_celsius")
    assert spark.sql("SELECT test_to_celsius('C', 7D) AS x").first().x == 7.0


def test_html_escape_equals_the_standard_library(spark):
    sample = "a<b>&\"c'd&amp;"
    assert one(spark, text.escape_html(F.lit(sample))) == html.escape(sample)


# ---- nested ----------------------------------------------------------------


def test_an_order_of_any_size_is_one_document(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,)], "o_orderkey long")
    lines = spark.range(2600).select(
        F.when(F.col("id") < 2500, 1).otherwise(2).cast("long").alias("l_orderkey"),
        F.col("id").cast("int").alias("l_linenumber"),
        F.col("id").alias("l_partkey"),
        F.lit(1.0).alias("l_quantity"),
        F.lit(2.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    documents_ = nested.nest_lines(orders, lines)
    sizes = sorted((r.o_orderkey, r.n) for r in documents_.select("o_orderkey", F.size("lines").alias("n")).collect())
    assert [s for s in sizes if s[0] < 3] == [(1, 2500), (2, 100)] and len(sizes) == 3
    assert documents_.where("o_orderkey = 1").first().lines[7].part == 7
    assert nested.explode_struct(documents_, "lines").count() == 2600


def test_empty_arrays_vanish_and_others_multiply(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b", "c"]), (2, [], ["a"])], "k int, x array<int>, y array<string>")
    assert nested.explode_all(df, {"i": "x", "j": "y"}).count() == 6


def test_boxplot_and_histogram(spark):
    df = spark.createDataFrame([("g", float(x)) for x in [1, 2, 3, 4, 100]], "g string, v double")
    box = profile.boxplot(df, ["v"], ["g"]).first()
    assert (box.p25, box.p50, box.p75, box.whisker_low, box.whisker_high, box.outliers) == (2, 3, 4, 1, 4, 1)
    assert {(r.bin, r.ct) for r in profile.histogram(df, "v", 10).collect()} == {(0, 4), (9, 1)}
    same = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert {(r.bin, r.ct) for r in profile.histogram(same, "v", 10).collect()} == {(0, 2)}


# ---- quality and log -------------------------------------------------------


def sample(spark):
    return spark.createDataFrame([(1, 5), (2, None), (3, -1)], "k int, v int")


def test_policies(spark):
    df = sample(spark)
    assert quality.enforce(df, [Rule("r", "v > 0", WARN)]).count() == 3
    assert [r.k for r in quality.enforce(df, [Rule("r", "v > 0", DROP)]).collect()] == [1]
    with pytest.raises(Exception, match="expectation r failed"):
        quality.enforce(df, [Rule("r", "v > 0", FAIL)]).collect()
    with pytest.raises(ValueError):
        Rule("r", "v > 0", "ignore")


def test_failed_rule_commits_nothing(spark, space):
    bad = quality.enforce(sample(spark), [Rule("r", "v > 0", FAIL)])
    with pytest.raises(Exception):
        bad.write.parquet(space.path("out"))
    with pytest.raises(Exception):
        spark.read.parquet(space.path("out")).count()


def test_null_counts_as_failed_and_reaches_the_report(spark):
    metrics = quality.measure(sample(spark), "d", [Rule("r", "v > 0"), Rule("s", "k > 0", DROP)])
    assert {tuple(r) for r in metrics.collect()} == {("d", "r", "warn", 1, 2), ("d", "s", "drop", 3, 0)}
    log = pipeline_log.quality_events(metrics, "u", F.lit("2024-01-01").cast("timestamp"))
    report = pipeline_log.expectation_report(log.unionByName(log))
    assert {tuple(r) for r in report.collect()} == {("d", "r", 2, 4), ("d", "s", 6, 0)}


# ---- features --------------------------------------------------------------


def trips(spark):
    data = [("10:00:00", 4.0), ("10:14:59", 6.0), ("10:15:00", 20.0), ("11:00:00", None)]
    return spark.createDataFrame([("z", f"2024-01-05 {c}", v) for c, v in data], "zip string, ts string, fare double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


def test_pickup_windows_equal_the_builtin_sliding_window(spark):
    df = trips(spark)
    own = features.pickup_features(df, "zip", "ts", "fare")
    builtin = df.groupBy("zip", F.window("ts", "1 hour", "15 minutes").alias("w")).agg(
        F.mean("fare").cast("float").alias("m"), F.count("*").cast("int").alias("n")
    )
    expected = {tuple(r) for r in builtin.select("zip", F.unix_timestamp("w.end").cast("int"), "m", "n").collect()}
    assert {(r[0], r[1], r[3], r[4]) for r in own.collect()} == expected
    assert own.schema["mean_fare_window_1h_pickup_zip"].dataType.simpleString() == "float"


def test_duplicate_feature_key_raises(spark, space):
    df = spark.createDataFrame([("z", 1, "2024-01", 1.0), ("z", 1, "2024-01", 2.0)], "zip string, ts int, yyyy_mm string, v double")
    with pytest.raises(Exception, match="duplicate primary key"):
        features.write_feature_table(df, space.path("f"), ["zip", "ts"], "yyyy_mm")


def test_floor_lookup_sees_no_later_trip(spark):
    df = trips(spark).withColumn("id", F.monotonically_increasing_id())
    pickup, dropoff = features.pickup_features(df, "zip", "ts", "fare"), features.dropoff_features(df, "zip", "ts")
    ceil = features.training_set(df, "zip", "ts", "ts", pickup, dropoff)
    floor = features.training_set(df, "zip", "ts", "ts", pickup, dropoff, as_of="floor")
    at = lambda d, clock: d.where(F.date_format("ts", "HH:mm:ss") == clock).first()
    assert at(ceil, "10:14:59").count_trips_window_1h_pickup_zip == 2
    assert at(floor, "10:14:59").count_trips_window_1h_pickup_zip is None
    assert at(floor, "10:15:00").count_trips_window_1h_pickup_zip == 2
    assert ceil.count() == floor.count() == 4
    with pytest.raises(ValueError):
        features.training_set(df, "zip", "ts", "ts", pickup, dropoff, as_of="nearest")


# ---- forecasts -------------------------------------------------------------


def series(spark):
    base = dt.date(2023, 1, 1)
    data = [("a", base + dt.timedelta(days=i), 100.0 + i + i % 3) for i in range(60) if i % 7 != 3]
    data += [("single", base, 5.0), ("gap", base, None)]
    return spark.createDataFrame(data, "`group` string, ds date, y double")


def test_forecast_rows_and_gaps(spark):
    got = forecast.forecast(series(spark), 30, dt.date(2024, 2, 1))
    counts = {r.group: (r.past, r.ahead) for r in got.groupBy("group").agg(
        F.count("y").alias("past"), F.count_if(F.col("y").isNull()).alias("ahead")).collect()}
    assert counts == {"a": (51, 30), "single": (1, 30)}
    last = got.where("group = 'a'").agg(F.max("ds")).first()[0]
    assert last == dt.date(2023, 2, 28) + dt.timedelta(days=30)
    future = got.where("group = 'a' AND y IS NULL").collect()
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in future)


def test_linear_series_is_fitted_closely(spark):
    got = forecast.evaluate(forecast.forecast(series(spark).where("group = 'a'"), 5, dt.date(2024, 2, 1))).first()
    assert got.mae < 3.0 and got.rmse == pytest.approx(got.mse**0.5)


def test_grouped_map_does_not_depend_on_partitioning(spark):
    df = series(spark).where("group = 'a'")
    fit = lambda d: {r.ds: round(r.yhat, 6) for r in forecast.forecast_grouped_map(d, 10, dt.date(2024, 2, 1)).collect()}
    assert fit(df.repartition(1)) == fit(df.repartition(7)) and len(fit(df)) == 61


def test_best_model_of_a_straight_line(spark):
    best = forecast.best_models(series(spark).where("group = 'a'")).first()
    assert best.mdape == min(best.trend, best.seasonal, best.last_value)


# ---- classification --------------------------------------------------------


def test_hash_split_ignores_the_layout(spark):
    df = spark.range(1000)
    first = [{r.id for r in p.collect()} for p in classify.hash_split(df.repartition(1), "id", [60, 20, 20])]
    second = [{r.id for r in p.collect()} for p in classify.hash_split(df.repartition(9), "id", [60, 20, 20])]
    assert first == second and sum(map(len, first)) == 1000 and all(first)


def test_models_beat_chance_and_name_their_features(spark):
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(400).select(
        F.col("id").cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"),
        F.when(F.col("id") > 200, "yes").otherwise("no").alias("target"),
    )
    ready = classify.preparation(["kind"], ["x"], "target").fit(df).transform(df)
    names = classify.feature_names(ready)
    assert names[-1] == "x" and len(names) == 3
    assert BinaryClassificationEvaluator().evaluate(LogisticRegression(maxIter=20).fit(ready).transform(ready)) > 0.95
    forest = RandomForestClassifier(numTrees=5, seed=1).fit(ready)
    assert classify.importances(forest, names)[0][0] == "x"
    search, rows = classify.tune(LogisticRegression(maxIter=3), {"regParam": [0.0, 1.0]}, ready, folds=2)
    assert [r[0] for r in rows] == ["regParam=0.0", "regParam=1.0"] and max(r[1] for r in rows) > 0.9
    scored = classify.probability_columns(forest.transform(ready), ["no", "yes"]).first()
    assert scored.prob_no + scored.prob_yes == pytest.approx(1.0) and scored.predicted in ("no", "yes")


# ---- streams ---------------------------------------------------------------


def messages(spark, low, high):
    rows = spark.range(low, high).select("id", F.timestamp_seconds("id").alias("at"))
    return ingest.to_messages(rows, "id", "at")


def test_stream_restarts_without_repeats_from_an_inclusive_start(spark, space):
    landing, sink, point = space.path("in"), space.path("out"), space.path("point")
    for low, high in ((0, 50), (50, 80)):
        ingest.send(messages(spark, low, high), landing)
        for _ in range(2):
            ingest.append(ingest.read_messages(spark, landing, start_offset=10, files_per_batch=2), sink, point)
    offsets = [r.offset for r in spark.read.parquet(sink).collect()]
    assert sorted(offsets) == list(range(10, 80))


def test_misfits_and_new_columns_are_kept(spark, space):
    waves = [
        ['{"id": 1, "v": 2, "s": {"a": 1}}', '{"id": 2, "v": null}', ""],
        ['{"id": 3, "v": "two", "s": {"a": "x"}, "w": [1, 2]}', '{"id": 4, "v": 2.5}', "no object", "[1]"],
        ['{"id": "five", "v": 5, "w": 7, "s": {"a": 9}}', "{broken", '{"id": 6, "v": 99999999999999999999}'],
    ]
    for i, lines in enumerate(waves):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(space.path("in"))
        for _ in range(2):  # a start with nothing new adds nothing
            stream = ingest.read_rescuing(spark, space.path("in"), space.path("schema"))
            ingest.append(stream, space.path("out"), space.path("point"))
        assert stream.columns == [["id", "s", "v", "_rescued"], ["id", "s", "v", "w", "_rescued"], ["id", "s", "v", "w", "_rescued"]][i]
    got = [r.asDict(recursive=True) for r in spark.read.option("mergeSchema", True).parquet(space.path("out")).collect()]
    by_id = {r["id"]: r for r in got if r["id"] is not None}
    assert len(got) == 9 and set(by_id) == {1, 2, 3, 4, 6}
    assert by_id[1] == {"id": 1, "v": 2, "s": {"a": 1}, "w": None, "_rescued": None}
    assert by_id[2]["_rescued"] is None and by_id[2]["v"] is None
    assert by_id[3]["w"] == [1, 2] and by_id[3]["_rescued"] == {"v": "two", "s": '{"a":"x"}'}
    assert by_id[4]["v"] is None and by_id[4]["_rescued"] == {"v": "2.5"}
    assert by_id[6]["_rescued"] == {"v": "99999999999999999999"}
    others = sorted((r["_rescued"] for r in got if r["id"] is None), key=str)
    assert {"id": "five", "w": "7"} in others and [r for r in got if (r["_rescued"] or {}).get("id") == "five"][0]["s"] == {"a": 9}
    assert {"": "no object"} in others and {"": "[1]"} in others and {"": "{broken"} in others


def test_types_of_a_rescuing_stream_can_be_given(spark, space):
    spark.createDataFrame([('{"id": 1, "code": 7}',), ('{"code": "x"}',)], "value string").write.text(space.path("in"))
    stream = ingest.read_rescuing(spark, space.path("in"), space.path("schema"), hints="code string, seen date")
    ingest.append(stream, space.path("out"), space.path("point"))
    got = spark.read.parquet(space.path("out"))
    assert got.columns == ["code", "seen", "id", "_rescued"] and sorted(r.code for r in got.collect()) == ["7", "x"]


def test_totals_follow_batches_and_a_replayed_batch_changes_nothing(spark, space):
    def total(df):
        return df.groupBy("day").agg(F.sum("v").alias("v"), F.count("*").alias("n"))

    def files():
        return {f for f in spark.read.parquet(space.path("gold")).inputFiles() if "day=d2" in f}

    def gold():
        return sorted(((str(r.day), r.v, r.n) for r in spark.read.parquet(space.path("gold")).collect()), key=str)

    schema = "v long, day string"
    first = [(1, "d1"), (2, "d1"), (3, "d2"), (4, None)]
    second = [(5, "d1"), (6, "d3"), (7, None)]  # the second day stays closed
    seen = []
    for rows in (first, second):
        spark.createDataFrame(rows, schema).write.mode("append").partitionBy("day").parquet(space.path("silver"))
        stream = ingest.read_new_files(spark, space.path("silver"), "parquet", schema)
        closed = files() if seen else set()
        ingest.keep_current(stream, space.path("silver"), "day", total, space.path("gold"), space.path("point"))
        seen += rows
        want = {d: [v for v, x in seen if x == d] for d in {x for _, x in seen}}
        assert gold() == sorted(((str(d), sum(v), len(v)) for d, v in want.items()), key=str)
    assert closed and closed == files()
    # All batches run again, as after a lost checkpoint.
    before = gold()
    stream = ingest.read_new_files(spark, space.path("silver"), "parquet", schema)
    ingest.keep_current(stream, space.path("silver"), "day", total, space.path("gold"), space.path("other-point"))
    assert gold() == before


def test_stream_of_csv_infers_types_once(spark, space):
    spark.range(20).withColumn("v", F.col("id") / 2).write.option("header", True).csv(space.path("in"))
    stream = ingest.read_new_files(spark, space.path("in"), "csv", header=True)
    ingest.append(stream, space.path("out"), space.path("point"))
    back = spark.read.parquet(space.path("out"))
    assert back.schema["v"].dataType.simpleString() == "double" and back.count() == 20


def test_cleaned_orders_drop_missing_numbers_and_keep_unknown_customers(spark):
    raw = spark.createDataFrame(
        [(1, 7, "n", "0", [("p", "USD", 2.0, 3.0)]), (None, 7, "n", "0", []), (2, 8, "m", "bad", [("q", "USD", 1.0, 1.0)])],
        "order_number int, customer_id int, customer_name string, order_datetime string, "
        "ordered_products array<struct<id: string, curr: string, price: double, qty: double>>",
    )
    customers = spark.createDataFrame([(7, "n", "LA")], "customer_id int, customer_name string, city string")
    cleaned = medallion.cleaned_orders(raw, customers)
    assert {(r.order_number, r.city, r.order_date) for r in cleaned.collect()} == {(1, "LA", dt.date(1970, 1, 1)), (2, None, None)}
    assert medallion.sales_by_city(cleaned, "LA").first().sales == 2.0


# ---- documents -------------------------------------------------------------


def test_page_offsets(spark):
    docs = spark.createDataFrame([(1, "ab\n\ncde\n"), (2, "")], "id int, t string")
    got = sorted((r.id, r.page, r.offset, r.text) for r in documents.page_offsets(docs, "id", "t").collect())
    assert got == [(1, 0, 0, "ab"), (1, 1, 2, ""), (1, 2, 2, "cde"), (1, 3, 5, ""), (2, 0, 0, "")]
    spaced = sorted((r.id, r.page, r.offset) for r in documents.page_offsets(docs, "id", "t", trailing_space=True).collect())
    assert spaced == [(1, 0, 0), (1, 1, 3), (1, 2, 4), (1, 3, 8), (2, 0, 0)]


def test_page_offsets_of_many_pages(spark):
    """Pages over several blocks, a block exactly full, and no page at all; 300,000 pages in one row."""
    for n in (0, 1, documents.BLOCK, documents.BLOCK + 1, 3 * documents.BLOCK + 7, 300_000):
        pages = F.expr(f"slice(transform(sequence(0, {max(n, 1) - 1}), i -> repeat('x', cast(i % 5 as int))), 1, {n})")
        placed = documents.page_map(spark.range(1), "id", pages)
        got = placed.agg(F.count("*").alias("n"), F.sum("offset").alias("s"), F.max("offset").alias("m")).first()
        sizes = [i % 5 for i in range(n)]
        before = [sum(sizes[:5]) * (i // 5) + sum(sizes[: i % 5]) for i in range(n)]
        assert (got.n, got.s or 0, got.m or 0) == (n, sum(before), max(before, default=0))
    nothing = spark.createDataFrame([(1, None)], "id int, p array<string>")
    assert documents.page_map(nothing, "id", F.col("p")).count() == 0


def test_table_html(spark):
    cells = spark.createDataFrame(
        [(1, 1, 1, "content", "x<", 1, 1), (1, 1, 0, "rowHeader", "r", 2, 1), (1, 0, 0, "columnHeader", "h", 1, 2)],
        "t int, row int, col int, kind string, content string, row_span int, col_span int",
    )
    assert documents.tables_to_html(cells, ["t"]).first().html == (
        "<table><tr><th colSpan=2>h</th></tr><tr><th rowSpan=2>r</th><td>x&lt;</td></tr></table>"
    )


def test_tables_replace_their_spans_once(spark):
    pages = spark.createDataFrame([(1, "0123456789"), (2, "plain")], "p int, text string")
    spans = spark.createDataFrame(
        [(1, 0, 2, 2, "<A>"), (1, 0, 6, 1, "<A>"), (1, 1, 8, 2, "<B>")], "p int, table_id int, start int, length int, html string"
    )
    got = {r.p: r.text for r in documents.inline_tables(pages, spans, ["p"]).collect()}
    assert got == {1: "01<A>457<B> ", 2: "plain "}


def test_markdown(spark):
    source = (
        "<head><title>t</title></head><h2 class='x'>Head</h2><p>a <b>bold</b> <a href=\"/u\">link</a>&amp;lt;</p>"
        "<ul><li>one</li><li>two</li></ul><script>var a = '<p>';</script><!-- no -->x<br/>y"
    )
    assert one(spark, documents.to_markdown(F.lit(source))) == (
        "## Head\n\na **bold** [link](/u)&lt;\n\n* one\n* two\n\nx  \ny"
    )


@pytest.mark.parametrize(
    "source, expected",
    [
        (
            "<table><tr><th>n</th><th>v</th></tr><tr><td>a</td><td>b <b>x</b></td></tr></table>after",
            "| n | v |\n| --- | --- |\n| a | b **x** |\n\nafter",
        ),
        (
            "<TABLE border=1>\n<tbody>\n <tr>\n <td>1</td> <td>2</td></tr>\n<tr><td>3</td><td>4</td></tr></TABLE><p>mid</p><table><tr><td>z</td></tr></table>",
            "| 1 | 2 |\n| --- | --- |\n| 3 | 4 |\n\nmid\n\n| z |\n| --- |",
        ),
        ("<ol><li>one</li><li>two</li></ol><ul><li>u</li></ul>", "1. one\n2. two\n\n* u"),
        ('<p>x <img src="s.png" alt="A b"> <img src="t.png"></p>', "x ![A b](s.png) ![](t.png)"),
        ("", ""),
    ],
)
def test_markdown_of_tables_lists_images(spark, source, expected):
    assert one(spark, documents.to_markdown(F.lit(source))) == expected


def test_whole_documents(spark):
    pages = spark.createDataFrame([(1, 1, "<p>b</p>"), (1, 0, "head 0123"), (2, 0, None)], "d int, p int, text string")
    table = "<table><tr><th>h</th></tr></table>"
    spans = spark.createDataFrame([(1, 0, 0, 5, 2, table)], "d int, p int, table_id int, start int, length int, html string")
    got = {r.d: r for r in documents.document_markdown(pages, spans, "d", "p").collect()}
    assert got[1].content == "head\n\n| h |\n| --- |\n\n23\n\nb"
    size = len("head 23 ") + len(table)
    assert [tuple(m) for m in got[1].page_map] == [(0, 0, size), (1, size, 9)]


def test_rules_and_counts_from_one_pass(spark, space):
    rules = [quality.Rule("small", "v < 6", quality.DROP), quality.Rule("known", "v IS NOT NULL", quality.WARN)]
    clean, counts = quality.enforce_and_measure(sample(spark), "t", rules, space)
    assert sorted(r.k for r in clean.collect()) == [1, 3] and clean.columns == ["k", "v"]
    assert {(r.name, r.passed_records, r.failed_records) for r in counts.collect()} == {("small", 2, 1), ("known", 2, 1)}
    with pytest.raises(Exception, match="expectation k failed"):
        quality.enforce_and_measure(sample(spark), "t", [quality.Rule("k", "k < 3", quality.FAIL)], space)


def test_features_cover_all_months(spark):
    both = trips(spark).unionByName(trips(spark).withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 MONTHS")))
    got = features.pickup_features(both, "zip", "ts", "fare")
    assert {r.yyyy_mm for r in got.collect()} == {"2024-01", "2024-03"}


def test_group_of_nulls_has_no_grouped_forecast(spark):
    got = forecast.forecast_grouped_map(series(spark).where("`group` <> 'single'"), 3, dt.date(2024, 2, 1))
    assert {r.group for r in got.select("group").distinct().collect()} == {"a"}


def test_profile_of_nulls_and_groups(spark):
    df = spark.createDataFrame([("g", 1.0, None), ("g", 3.0, None), ("h", None, None)], "g string, v double, w double")
    got = {(r.g, r.column_name): r for r in profile.summarize(df, ["v", "w"], ["g"]).collect()}
    assert len(got) == 4 and (got["g", "v"].n, got["g", "v"].mean, got["g", "v"].p50) == (2, 2.0, 2.0)
    assert got["g", "v"].stddev == pytest.approx(2**0.5) and got["h", "v"].n == 0 and got["h", "v"].min is None
    nameless = spark.createDataFrame([(None, 1.0), (None, 2.0), ("h", 5.0)], "g string, v double")
    got = {r.g: r for r in profile.summarize(nameless, ["v"], ["g"]).collect()}
    assert (got[None].n, got[None].p50, got["h"].p50) == (2, 1.5, 5.0)
    none = profile.summarize(nameless.limit(0), ["v"]).first()
    assert (none.n, none["mean"], none.p50) == (0, None, None)


def test_rolling_errors_judge_unseen_days(spark):
    """A series that doubles after the cut-off: each candidate is judged on the days it has not seen."""
    base = dt.date(2023, 1, 1)
    data = [("flat", base + dt.timedelta(days=i), 10.0) for i in range(100)]
    data += [("line", base + dt.timedelta(days=i), 100.0 + 2 * i) for i in range(100)]
    data += [("week", base + dt.timedelta(days=i), 50.0 * (1 + i % 7)) for i in range(100)]
    data += [("jump", base + dt.timedelta(days=i), 10.0 if i < 90 else 20.0) for i in range(100)]
    data += [("short", base + dt.timedelta(days=i), 10.0) for i in range(12)] + [("flat", None, 3.0), ("flat", base, None)]
    table = spark.createDataFrame(data, "`group` string, ds date, y double").repartition(5)
    errors = forecast.rolling_errors(table, cutoffs=3, days=10)
    got = {(r.group, r.cutoff): r for r in errors.collect()}
    last = base + dt.timedelta(days=99)
    assert {g for g, _ in got} == {"flat", "line", "week", "jump", "short"} and sum(g == "short" for g, _ in got) == 1
    for k in (1, 2, 3):
        cutoff = last - dt.timedelta(days=10 * k)
        flat, line, week = (got[g, cutoff] for g in ("flat", "line", "week"))
        assert flat.days == 10 and max(flat.last_value, flat.seasonal, flat.trend) < 1e-9
        days = [100 + 2 * (99 - 10 * k + j) for j in range(1, 11)]
        assert line.trend < 1e-9 and abs(line.last_value - np.median([2 * j / d for j, d in enumerate(days, 1)])) < 1e-9
        assert week.seasonal < 0.2 < week.last_value
    jump = got["jump", last - dt.timedelta(days=10)]
    assert abs(jump.last_value - 0.5) < 1e-9 and jump.trend > 0.4  # nothing of the jump was known
    best = {r.group: r for r in forecast.best_unseen(errors).collect()}
    assert best["line"].model != "last_value" and best["line"].mdape < 1e-9 and best["week"].model == "seasonal" and best["short"].cutoffs == 1
    assert forecast.rolling_errors(table.limit(0)).collect() == []


def test_broken_trend_finds_a_known_break(spark):
    base = dt.date(2023, 1, 1)
    shape = lambda i: 100.0 + i if i <= 60 else 160.0 - 3 * (i - 60)
    data = [("bent", base + dt.timedelta(days=i), shape(i)) for i in range(121)]
    data += [("line", base + dt.timedelta(days=i), 5.0 + i) for i in range(121) if i % 3] + [("one", base, 7.0)]
    table = spark.createDataFrame(data, "`group` string, ds date, y double").repartition(3)
    rows = {}
    for r in forecast.broken_trend(table, 40, breaks=1, ridge=0.0).orderBy("ds").collect():
        rows.setdefault(r.group, []).append(r)
    assert len(rows["bent"]) == 161 and len(rows["line"]) == 120 and len(rows["one"]) == 41
    for i, r in enumerate(rows["bent"]):
        assert abs(r.yhat - shape(i)) < 1e-6
    widths = [r.yhat_upper - r.yhat for r in rows["bent"] if r.y is None]
    assert all(b > a for a, b in zip(widths, widths[1:])) and widths[-1] > 50 * max(r.yhat_upper - r.yhat for r in rows["bent"] if r.y is not None)
    straight = [r.yhat_upper - r.yhat for r in rows["line"]]
    assert max(straight) < 1e-3  # no bend was seen, so none is expected
    assert all(r.yhat == 7.0 and r.yhat_upper == r.yhat_lower for r in rows["one"])


def test_broken_trend_equals_least_squares(spark):
    rng = np.random.default_rng(5)
    base, y = dt.date(2022, 1, 1), np.cumsum(rng.normal(size=200)) + 50
    table = spark.createDataFrame([("g", base + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)], "`group` string, ds date, y double")
    got = [r.yhat for r in forecast.broken_trend(table, 20, breaks=4, ridge=0.01).orderBy("ds").collect()]
    t = np.arange(220) / 199
    x = np.column_stack([np.ones(220), t, *[np.maximum(t - k / 5, 0) for k in range(1, 5)]])
    a = x[:200].T @ x[:200] + np.diag([0, 0, 2.0, 2.0, 2.0, 2.0])
    assert np.allclose(got, x @ np.linalg.solve(a, x[:200].T @ y), atol=1e-6)


def test_markdown_of_a_long_text_after_a_table(spark):
    """A long text after a table, or a long cell, is read in steps, not in one call inside another for each letter."""
    from millrace.operators import documents

    long = "some words < more\n" * 20_000
    table = f"<table><TR><th>a<td class='x'>b</td></TR><tr><td>c</td><td>{'d' * 100_000}</td></tr></table>"
    html = f"x <table><tr><th>h</th></tr><tr><td>1</td></tr></table>{long}{table}{long}"
    frame = spark.createDataFrame([(html,), ("plain & <3",), (None,), ("<H2>t</H2><ul><li>i</ul>",)], "html string")
    got = [r[0] for r in frame.select(documents.to_markdown("html")).collect()]
    assert got[0].startswith("x\n\n| h |\n| --- |\n| 1 |\n\nsome words") and "d" * 100_000 + " |" in got[0]
    assert got[1:] == ["plain & <3", None, "## t\n\n* i"]
