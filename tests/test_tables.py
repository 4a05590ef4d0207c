"""Sources, sinks and merge."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import Workspace, session, sinks
from millrace.operators.merge import merge, merge_partitions
from millrace.plans.scans import PART_SCHEMA
from millrace.sources import files, generate, jdbc, tables
from millrace.sources.copy_into import TypeClash, common_type, copy_into, read_copied


def text(spark, space, name, lines):
    path = space.path(name)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


BAD_LINES = ["1,2,3.5", "x,0,0.7", "3,abc,1.0", "4"]


def test_permissive_keeps_what_parses(spark, space):
    got = files.read_csv(spark, text(spark, space, "bad", BAD_LINES), PART_SCHEMA, header=False).collect()
    assert [tuple(r) for r in got] == [(1, 2, 3.5), (None, 0, 0.7), (3, None, 1.0), (4, None, None)]


def test_dropmalformed_counts_unselected_columns(spark, space):
    path = text(spark, space, "bad", BAD_LINES)
    df = files.read_csv(spark, path, PART_SCHEMA, header=False, mode="DROPMALFORMED")
    assert [r[0] for r in df.select("p_partkey").collect()] == [1]


def test_failfast_raises(spark, space):
    df = files.read_csv(spark, text(spark, space, "bad", BAD_LINES), PART_SCHEMA, header=False, mode="FAILFAST")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        df.collect()


def test_bad_records_are_kept_apart(spark, space):
    path = text(spark, space, "bad", BAD_LINES)
    good, bad = files.split_bad_records(spark, path, PART_SCHEMA, space.path("captured"))
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.5)]
    assert [tuple(r) for r in good.select("p_partkey").collect()] == [(1,)]
    assert good.count() == 1 and good.agg(F.sum("p_retailprice")).first()[0] == 3.5
    assert {r.record for r in bad.collect()} == set(BAD_LINES[1:])
    assert all("bad" in r.path for r in bad.collect())


def test_json_shapes(spark, space):
    lines = text(spark, space, "lines", ['{"a":1,"b":2,"c":3},', '{"a":10,"b":20,"c":30}'])
    assert {r.a for r in files.read_json(spark, lines).collect()} == {1, 10}
    array = text(spark, space, "array", ["[", '{"a":1,"b":2},', '{"a":10,"b":20}', "]"])
    assert files.read_json(spark, array, multiline=True).count() == 2
    assert "_corrupt_record" in files.read_json(spark, array).columns
    nested = text(spark, space, "nested", [json.dumps([{"a": 1, "d": [{"city": "x", "Country": "y"}]}, {"a": 2, "d": []}])])
    assert files.read_json(spark, nested).selectExpr("a", "inline(d)").columns == ["a", "Country", "city"]


def test_reader_by_extension(spark, space):
    df = spark.range(5)
    df.write.parquet(space.path("x.parquet"))
    df.write.option("header", True).csv(space.path("x.csv"))
    for name in ("x.parquet", "x.csv"):
        assert files.read_path(spark, space.path(name)).count() == 5
    with pytest.raises(ValueError):
        files.read_path(spark, space.path("x.unknown"))


def test_json_arrays_are_whole(spark, space):
    sinks.write_json_arrays(spark.range(25).repartition(3), space.path("arrays"))
    back = files.read_json(spark, space.path("arrays"), multiline=True)
    assert sorted(r.id for r in back.collect()) == list(range(25))


def test_copy_into_loads_each_file_once(spark, space):
    source, target = space.path("in"), space.path("out")
    spark.range(3).write.json(source)
    assert copy_into(spark, target, source, "json", "*.json") > 0
    assert copy_into(spark, target, source, "json", "*.json") == 0
    spark.range(3, 5).withColumn("extra", F.lit("e")).write.mode("append").json(source)
    copy_into(spark, target, source, "json", "*.json")
    assert {(r.id, r.extra) for r in read_copied(spark, target).collect()} == {
        (0, None), (1, None), (2, None), (3, "e"), (4, "e"),
    }


def test_unfinished_load_is_invisible_and_repeatable(spark, space):
    source, target = space.path("in"), space.path("out")
    spark.range(3).write.json(source)
    spark.range(100, 103).write.parquet(f"{target}/data/_load=1")
    copy_into(spark, target, source, "json", "*.json")
    spark.range(200, 203).write.parquet(f"{target}/data/_load=2")
    assert sorted(r.id for r in read_copied(spark, target).collect()) == [0, 1, 2]


def load(spark, source, target, rows, schema, **options):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
    return copy_into(spark, target, source, "json", "*.json", **options)


def test_loads_with_other_types_widen(spark, space):
    source, target = space.path("in"), space.path("out")
    load(spark, source, target, [(1, 5)], "id int, v int")
    load(spark, source, target, [(2, 2.5)], "id int, v double")
    assert dict(read_copied(spark, target).dtypes) == {"id": "bigint", "v": "double"}
    load(spark, source, target, [(3, "x"), (4, None)], "id int, v string")
    got = read_copied(spark, target)
    assert dict(got.dtypes) == {"id": "bigint", "v": "string"}
    assert {tuple(r) for r in got.collect()} == {(1, "5"), (2, "2.5"), (3, "x"), (4, None)}
    assert copy_into(spark, target, source, "json", "*.json") == 0
    pushed = got.where("id = 3")._jdf.queryExecution().executedPlan().toString()
    assert pushed.count("EqualTo(id,3)") == 3  # one scan per schema, each with the filter


def test_loads_without_a_common_type_are_refused_before_they_are_seen(spark, space):
    source, target = space.path("in"), space.path("out")
    load(spark, source, target, [(1, (5,))], "id int, v struct<a:int>")
    for _ in range(2):  # also when tried again
        with pytest.raises(TypeClash, match="v: struct"):
            load(spark, source, target, [(2, "x")], "id int, v string")
        assert read_copied(spark, target).count() == 1
    with pytest.raises(ValueError):
        read_copied(spark, space.path("empty"))


def test_loads_can_insist_on_their_types(spark, space):
    source, target = space.path("in"), space.path("out")
    load(spark, source, target, [(1, 5)], "id int, v int", widen=False)
    with pytest.raises(TypeClash, match="v"):
        load(spark, source, target, [(2, "x")], "id int, v string", widen=False)
    assert read_copied(spark, target).count() == 1


def test_nested_types_are_merged_by_field(spark, space):
    source, target = space.path("in"), space.path("out")
    load(spark, source, target, [(1, [(5, "a")])], "id int, v array<struct<n:int,s:string>>")
    load(spark, source, target, [(2, [(0.5, True)]), (3, None)], "id int, v array<struct<n:double,more:boolean>>")
    got = {r.id: r.v for r in read_copied(spark, target).collect()}
    assert [tuple(x) for x in got[1]] == [(5.0, "a", None)] and [tuple(x) for x in got[2]] == [(0.5, None, True)] and got[3] is None


@pytest.mark.parametrize(
    "a, b, want",
    [("int", "bigint", "bigint"), ("bigint", "float", "double"), ("float", "float", "float"), ("decimal(5,2)", "decimal(4,4)", "decimal(7,4)"),
     ("decimal(5,2)", "int", "double"), ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("boolean", "int", "string"), ("void", "int", "int"),
     ("map<string,int>", "map<string,double>", "map<string,double>")],
)
def test_common_types(spark, a, b, want):
    kind = lambda text: T.StructType.fromDDL(f"c {text}").fields[0].dataType
    assert common_type(kind(a), kind(b)).simpleString() == common_type(kind(b), kind(a)).simpleString() == want


def test_tables_from_before_types_were_kept(spark, space):
    source, target = space.path("in"), space.path("out")
    spark.createDataFrame([(1, 5)], "id int, v int").write.parquet(f"{target}/data/_load=1")
    spark.createDataFrame([("file:/old", 1, 1)], "path string, length bigint, load_id int").write.parquet(f"{target}/loads")
    load(spark, source, target, [(2, "x")], "id int, v string")
    assert {tuple(r) for r in read_copied(spark, target).collect()} == {(1, "5"), (2, "x")}


def test_jdbc_options_and_ranges():
    assert jdbc.jdbc_options("jdbc:x", "t", driver="d", fetchsize=5) == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "5", "driver": "d",
    }
    with pytest.raises(ValueError):
        jdbc.read_jdbc(None, "jdbc:x", "t", partitions=4)


def test_pandas_both_ways(spark):
    import pandas as pd

    df = generate.from_pandas(spark, pd.DataFrame({"a": [1, 2, 3]}))
    assert generate.to_pandas(df, 3)["a"].sum() == 6
    with pytest.raises(ValueError):
        generate.to_pandas(df, 2)


def test_workspace_uses_the_shared_folder(spark, space):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert space.root.startswith(named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir"))
    one, two = space.keep(spark.range(3), "t"), space.keep(spark.range(5), "t")
    assert (one.count(), two.count()) == (3, 5)
    other = space.keep(spark.range(1), "other")
    space.drop("t", "unknown")
    assert other.count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{space.root}/t-1")


@pytest.mark.parametrize("named, want", [("s3://b/x/", "s3://b/x"), (None, "hdfs:/wh/millrace-scratch")])
def test_scratch_is_never_a_local_temporary_folder(named, want):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": named or default, "spark.sql.warehouse.dir": "hdfs:/wh"}[key]

    class Fake:
        conf = Conf()

    assert session.shared_folder(Fake()) == want


def test_append_insert_and_describe(spark, space):
    name = space.table("t")
    sinks.save_table(spark.range(2), name)
    sinks.save_table(spark.range(2, 4), name, mode="append")
    assert spark.table(name).count() == 4
    assert [tuple(r) for r in tables.describe(spark, name).collect()] == [("id", "bigint")]


def test_partitioned_write_gathers_rows(spark, space):
    df = spark.range(1000).repartition(8).withColumn("p", F.col("id") % 3)
    sinks.write_partitioned(df, space.path("p"), ["p"])
    back = spark.read.parquet(space.path("p"))
    assert back.count() == 1000 and len(back.inputFiles()) == 3


# ---- merge -----------------------------------------------------------------


def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, name string, v int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_updates_and_inserts(spark):
    source = spark.createDataFrame([(2, "B", 99), (3, "c", 30), (None, "m", 1)], "k int, name string, v int")
    got = rows(merge(target(spark), source, ["k"], update=["name"], insert=["k", "name"]))
    assert got == sorted([(1, "a", 10), (2, "B", 20), (None, "n", 0), (3, "c", None), (None, "m", None)], key=str)


def test_merge_sets_null_from_the_source(spark):
    source = spark.createDataFrame([(1, None, None)], "k int, name string, v int")
    assert (1, None, None) in rows(merge(target(spark), source, ["k"]))


def test_ambiguous_match_raises_but_repeated_inserts_do_not(spark):
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, name string, v int")
    with pytest.raises(Exception, match="several source rows"):
        merge(target(spark), twice, ["k"]).collect()
    for asked in (lambda d: d.count(), lambda d: d.select("k").collect()):
        with pytest.raises(Exception, match="several source rows"):
            asked(merge(target(spark), twice, ["k"]))
    fresh = spark.createDataFrame([(9, "x", 1), (9, "y", 2)], "k int, name string, v int")
    assert merge(target(spark), fresh, ["k"]).count() == 5


def test_small_source_leaves_target_keys_where_they_are(spark, space):
    """No exchange of all target keys: the semi join against a small source is a broadcast."""
    space.keep(spark.range(200_000).select(F.col("id").alias("k"), F.lit("n").alias("name"), F.lit(1).alias("v")), "big")
    big = spark.read.parquet(f"{space.root}/big-1")
    source = spark.createDataFrame([(5, "z", 5), (-1, "new", 0)], "k long, name string, v int")
    merged = merge(big, source, ["k"])
    assert merged.count() == 200_001
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [k" in plan and "LeftSemi" in plan


def test_merge_updates_every_row_of_a_repeated_target_key(spark):
    many = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("name"), F.lit(0).alias("v"))
    source = spark.createDataFrame([(1, "z", 5)], "k int, name string, v int")
    got = merge(many, source, ["k"], update=["v"])
    assert got.count() == 3000 and got.where("v = 5").count() == 3000


def test_partition_merge_leaves_other_folders_alone(spark, space):
    path = space.path("t")
    rows_ = [(d, k, k * 10) for d in ("2024-01-01", "2024-01-02", "2024-01-03") for k in (1, 2)]
    df = spark.createDataFrame(rows_, "d string, k int, v int").withColumn("d", F.to_date("d"))
    sinks.write_partitioned(df, path, ["d"])
    others = lambda: {f for f in spark.read.parquet(path).inputFiles() if "d=2024-01-02" not in f}
    before = others()
    source = spark.createDataFrame([("2024-01-02", 2, 99), ("2024-01-02", 3, 30)], "d string, k int, v int")
    source = source.withColumn("d", F.to_date("d"))
    assert merge_partitions(spark, path, source, ["d", "k"], "d", space.path("s")) == 1
    got = {(str(r.d), r.k, r.v) for r in spark.read.parquet(path).collect()}
    assert got == ({t for t in rows_ if t[:2] != ("2024-01-02", 2)} | {("2024-01-02", 2, 99), ("2024-01-02", 3, 30)})
    assert before == others() and len(before) == 2
    with pytest.raises(ValueError):
        merge_partitions(spark, path, source, ["k"], "d", space.path("s2"))
    with pytest.raises(ValueError):
        merge_partitions(spark, path, source.withColumn("d", F.lit(None).cast("date")), ["d", "k"], "d", space.path("s3"))
