"""Ordered work inside groups against brute force, with a hot key, nulls and texts."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify, ordered
from millrace.operators.ordered import exact_percentiles, numbered, running_totals
from millrace.operators.relational import first_per_key, null_counts, share_of_total, underscore_names

def rows(seed=1, n=3000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        order = 7 if rng.random() < 0.3 else rng.choice([None, *range(40)])
        out.append((key, order, i, rng.randint(0, 9)))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "k string, o int, i int, v int").repartition(6)


def brute(data, descending=False):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    number, total = {}, {}
    for key, members in groups.items():
        low = -1
        if descending:
            members.sort(key=lambda r: (-(low if r[1] is None else r[1]), r[2]))
        else:
            members.sort(key=lambda r: (low if r[1] is None else r[1], r[2]))
        running = 0
        for position, row in enumerate(members, 1):
            running += row[3]
            number[row[2]], total[row[2]] = position, running
    return number, total


@pytest.mark.parametrize("descending", [False, True])
def test_numbers_and_totals_match_brute_force(spark, descending):
    data = rows()
    number, total = brute(data, descending)
    df = frame(spark, data)
    got = numbered(df, ["k"], "o", "i", "n", descending).collect()
    assert {r.i: r.n for r in got} == number
    sums = running_totals(df, ["k"], "o", "i", {"t": "v"}, whole=True, descending=descending).collect()
    assert {r.i: r.t for r in sums} == total
    whole = {}
    for key, _, _, v in data:
        whole[key] = whole.get(key, 0) + v
    assert {(r.k, r.t_whole) for r in sums} == set(whole.items())


def test_one_value_everywhere_is_cut_by_the_tie(spark):
    data = [("hot", 5, i, 1) for i in range(2000)]
    got = numbered(frame(spark, data), ["k"], "o", "i", "n").collect()
    assert all(r.n == r.i + 1 for r in got) and len(got) == 2000


def test_ranges_keep_a_hot_key_out_of_one_task(spark):
    from millrace.operators.ordered import with_ranges

    ranged = with_ranges(frame(spark, [("hot", i % 3, i, 1) for i in range(4000)]), "o", "i")
    sizes = [r["count"] for r in ranged.groupBy("_range", "_tie_range").count().collect()]
    assert max(sizes) < 4000 / 4


def test_empty_input(spark):
    df = frame(spark, [])
    assert numbered(df, ["k"], "o", "i", "n").count() == 0
    assert exact_percentiles(df, ["k"], "o", {"m": 0.5}).count() == 0


def test_percentiles_equal_the_builtin(spark):
    df = frame(spark, rows(2))
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99, "lo": 0.0, "hi": 1.0}
    own = exact_percentiles(df, ["k"], "o", probs)
    builtin = df.groupBy("k").agg(*[F.percentile("o", F.lit(p)).alias(n) for n, p in probs.items()])
    as_set = lambda d: {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.collect()}
    assert as_set(own.select("k", *probs)) == as_set(builtin)


@pytest.mark.parametrize(
    ("margin", "accuracy", "most"), [(ordered.MARGIN, ordered.ACCURACY, ordered.WINDOW_ROWS), (0.001, 5, ordered.WINDOW_ROWS), (0.3, 5, 10)]
)
def test_percentiles_of_many_values(spark, monkeypatch, margin, accuracy, most):
    """Skewed and continuous columns, heavy values, a null key; coarse sketches miss ranks, and wider brackets find them."""
    monkeypatch.setattr(ordered, "MARGIN", margin)
    monkeypatch.setattr(ordered, "ACCURACY", accuracy)
    monkeypatch.setattr(ordered, "WINDOW_ROWS", most)
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 7))
    unit = (F.abs(F.xxhash64("id")) % 1_000_003) / 1_000_003.0
    value = F.when(F.col("id") % 5 == 0, 0.5).when(F.col("id") % 11 == 0, None).otherwise(F.pow(unit, 4) - 0.1)
    df = spark.range(60_000).select(key.alias("k"), value.alias("v"))
    probs = {"p25": 0.25, "p50": 0.5, "p999": 0.999}
    for keys in (["k"], []):
        own = exact_percentiles(df, keys, "v", probs).select(*keys, *probs)
        builtin = df.groupBy(*keys).agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()])
        as_set = lambda d: {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in d.collect()}
        assert as_set(own) == as_set(builtin)


def test_percentiles_count_only_values_near_the_ranks(spark, space):
    """Of 100,000 distinct values some hundreds stay apart; the others are counted per gap, none is lost."""
    df = spark.range(100_000).select(F.lit("k").alias("k"), F.xxhash64("id").cast("double").alias("v"))
    counts = ordered._near_counts(df, ["k"], "v", [0.25, 0.5], ordered.MARGIN, space)
    assert counts.count() < 1000 and counts.agg(F.sum("_n")).first()[0] == 100_000
    assert counts.where("_gap = 1").count() == 3


def test_areas_count_ties_once(spark):
    data = [(0.9, 1), (0.8, 1), (0.8, 0), (0.3, 0), (0.3, 1), (0.1, 0)]
    df = spark.createDataFrame(data, "score double, y int")
    points = classify.roc_points(df, "score", F.col("y") == 1)
    area = classify.areas(points).first()
    pairs = [(a, b) for a, ya in data for b, yb in data if ya == 1 and yb == 0]
    assert area.area_roc == pytest.approx(sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs))
    assert points.count() == 4


@pytest.mark.parametrize("order", ["o", "name"])
def test_sums_over_nulls_and_text_orders(spark, order):
    """As the plain window has it: null until a value comes, texts in their own order."""
    from pyspark.sql import Window

    rng = random.Random(9)
    heads = ["", "a", "abcdef", "abcdefgh", "é", "zzz", "abcdefga"]
    data = [
        (rng.choice(["hot", "hot", "x"]), rng.choice([None, 1, 2, 3]), rng.choice([None, rng.choice(heads) + str(rng.randint(0, 30))]), i,
         None if i < 300 or rng.random() < 0.3 else rng.randint(0, 9))
        for i in range(900)
    ]
    df = spark.createDataFrame(data, "k string, o int, name string, i int, v int").repartition(5)
    plain = Window.partitionBy("k").orderBy(order, "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("i", F.sum("v").over(plain).alias("t")).collect()
    got = running_totals(df, ["k"], order, "i", {"t": "v"}).select("i", "t").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


def test_first_per_key_and_shares(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, None), (None, 3, "c")], "k int, o int, v string")
    assert {tuple(r) for r in first_per_key(df, ["k"], ["o"]).collect()} == {(1, 1, "a"), (2, 5, None), (None, 3, "c")}
    shares = {r.k: (r.ct, r.total, r.pct) for r in share_of_total(df, ["k"]).collect()}
    assert shares == {1: (2, 4, 50.0), 2: (1, 4, 25.0), None: (1, 4, 25.0)}
    assert {tuple(r) for r in null_counts(df).collect()} == {("k", 1), ("o", 0), ("v", 1)}
    assert underscore_names(df.toDF("a b", "c", "d e f")).columns == ["a_b", "c", "d_e_f"]
