"""Models' own numbers against recomputation."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.scoring import Scorer, scoring_function
from millrace.operators import classify as cl
from millrace.plans import QUERIES, models

FOLDER = "/root/testdata/sf0.01"
CLASSIFIERS = {
    "logistic": lambda: LogisticRegression(maxIter=10),
    "tree": lambda: DecisionTreeClassifier(maxDepth=4, seed=1),
    "forest": lambda: RandomForestClassifier(numTrees=7, maxDepth=4, seed=1),
    "boosted": lambda: GBTClassifier(maxIter=4, seed=1),
}


@pytest.fixture(scope="module")
def measured(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = models._with_measures(docs).join(spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality"), "doc_id")
    return rows.withColumn("label", F.col("quality").cast("double")).cache()


@pytest.fixture(scope="module")
def fitted(measured):
    steps = cl.preparation(models.CATEGORICAL, models.NUMERIC).getStages()
    return {name: Pipeline(stages=[*steps, c()]).fit(measured) for name, c in CLASSIFIERS.items()}


def area(label, score):
    """Share of (positive, negative) pairs in the right order; ties count half."""
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("name", list(CLASSIFIERS))
def test_function_equals_transform(spark, measured, fitted, name):
    odd = measured.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "xx").when(F.col("doc_id") % 5 == 1, None).otherwise(F.col("lang")))
    score = scoring_function(spark, fitted[name])
    both = fitted[name].transform(odd.withColumn("s", score(F.struct(*models.CATEGORICAL, *models.NUMERIC)))).withColumn("p", vector_to_array("probability"))
    rows = both.select("label", "prediction", "p", "s").collect()
    assert all(r.prediction == r.s.prediction and np.allclose(r.p, r.s.probability, rtol=0, atol=1e-12) for r in rows)
    p = np.array([r.p[1] for r in rows])
    assert len(set(p)) > 2 and area(np.array([r.label for r in rows]), p) > 0.55  # no constant


def test_logistic_from_its_weights(measured, fitted):
    model = fitted["logistic"]
    rows = model.transform(measured).select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("p")).collect()
    weights = dict(cl.coefficients(model.stages[-1], [str(i) for i in range(model.stages[-1].numFeatures)]))
    w = np.array([weights[str(i)] for i in range(model.stages[-1].numFeatures)])
    want = 1 / (1 + np.exp(-(np.array([r.x for r in rows]) @ w + weights["(intercept)"])))
    assert np.allclose([r.p[1] for r in rows], want, atol=1e-9)


def test_tree_leaves_hold_the_shares_of_their_rows(measured, fitted):
    scorer, frame = Scorer(fitted["tree"]), measured.toPandas()
    x = scorer.features(frame)
    at, label = scorer.trees[0].leaves(x), frame["label"].to_numpy()
    for leaf in np.unique(at):
        counts = np.array(scorer.trees[0].leaf[leaf])
        assert counts.sum() == (at == leaf).sum() and counts[1] / counts.sum() == label[at == leaf].mean()


def test_forest_is_the_mean_of_its_trees(measured, fitted):
    scorer, frame = Scorer(fitted["forest"]), measured.toPandas()
    x = scorer.features(frame)
    means = np.mean([t.shares(x) for t in scorer.trees], axis=0)
    got = {r.doc_id: r.p for r in fitted["forest"].transform(measured).select("doc_id", vector_to_array("probability").alias("p")).collect()}
    assert np.allclose([got[i] for i in frame["doc_id"]], means, atol=1e-12)


def test_rows_without_a_number_have_no_score(spark, fitted, measured):
    score = scoring_function(spark, fitted["tree"])
    rows = measured.limit(4).withColumn("n_words", F.when(F.col("doc_id") >= 0, F.lit(None).cast("double")))
    assert {(r.s.prediction, r.s.probability) for r in rows.select(score(F.struct(*models.CATEGORICAL, *models.NUMERIC)).alias("s")).collect()} == {(None, None)}


def test_function_in_sql_and_in_a_stream(spark, measured, fitted, space):
    spark.udf.register("score_test", scoring_function(spark, fitted["forest"]))
    measured.drop("label").write.parquet(space.path("in"))
    columns = ", ".join([*models.CATEGORICAL, *models.NUMERIC])
    batch = spark.sql(f"SELECT doc_id, score_test(struct({columns})).probability[1] AS p FROM {{r}}", r=spark.read.parquet(space.path("in")))
    stream = spark.readStream.schema(measured.drop("label").schema).parquet(space.path("in")).selectExpr("doc_id", f"score_test(struct({columns})).probability[1] AS p")
    stream.writeStream.format("parquet").option("path", space.path("out")).option("checkpointLocation", space.path("cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, spark.read.parquet(space.path("out")).collect()))


def test_only_whole_scoring_pipelines(spark, measured):
    strict = Pipeline(stages=[StringIndexer(inputCol="lang", outputCol="i")]).fit(measured)
    with pytest.raises(ValueError, match="keep unknown"):
        Scorer(strict)
    with pytest.raises(ValueError, match="without a classifier"):
        Scorer(cl.preparation(models.CATEGORICAL, models.NUMERIC).fit(measured))


def test_registered_numbers(spark):
    """The keys hold real numbers: a model that predicts a constant would fail each of these."""
    rows = {k: QUERIES[k](spark, FOLDER).collect() for k in ("logreg_scores", "forest_scores", "tree_scores", "prediction_counts", "feature_importance", "model_quality")}
    for key in ("logreg_scores", "forest_scores", "tree_scores"):
        label, p = (np.array([r[c] for r in rows[key]]) for c in ("label", "prob_1"))
        assert len(set(p)) > 2 and area(label, p) > 0.55
    assert len({r.prediction for r in rows["prediction_counts"]}) == 2
    weights = [r.importance for r in rows["feature_importance"]]
    assert weights == sorted(weights, reverse=True) and weights[0] > 0 and abs(sum(weights) - 1) < 1e-9
    assert {r.model for r in rows["model_quality"]} == set(CLASSIFIERS) and all(0.55 < r.area_roc <= 1 for r in rows["model_quality"])


def test_areas_against_pairs(spark):
    scored = QUERIES["logreg_scores"](spark, FOLDER).select("label", F.round("prob_1", 1).alias("score")).cache()
    own = cl.areas(cl.roc_points(scored, "score", F.col("label") == 1.0)).first()
    label, score = np.array(scored.collect()).T
    assert abs(own.area_roc - area(label, score)) < 1e-9


def test_vectorised_text_functions(spark):
    """Against another engine's forms, on odd and on random texts."""
    import random

    import duckdb

    from millrace.functions import vectorised

    r = random.Random(8)
    words = ["", "a", "ab", "ba", "martha", "marhta", "dwayne", "duane", "dixon", "dicksonx", "éàü", "straße", "ÅÉÎ õ ñ", "中文", "İstanbul", "x" * 70]
    words += ["".join(r.choice("abcdé") for _ in range(r.randint(0, 80))) for _ in range(120)]
    pairs = [(r.choice(words), r.choice(words)) for _ in range(800)] + [(None, "a"), ("a", None), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(3)
    got = {(x.a, x.b): (x.s, x.p) for x in df.select("a", "b", vectorised.name_similarity()("a", "b").alias("s"), vectorised.strip_accents()("a").alias("p")).collect()}
    for a, b in pairs:
        want = duckdb.execute("SELECT jaro_winkler_similarity(?, ?), strip_accents(?)", [a, b, a]).fetchone()
        similar, plain = got[a, b]
        assert (a is None or b is None) == (similar is None) and plain == want[1]
        if similar is not None and (a or b) and (a + b).isascii():
            assert abs(similar - want[0]) < 1e-9, (a, b)


def test_halving_search(spark, measured):
    ready = cl.preparation(models.CATEGORICAL, models.NUMERIC).fit(measured).transform(measured).select("doc_id", "label", "features")
    rows = ready.withColumn("held", cl.part_of("doc_id", [70, 30], seed=7) == 1).cache()
    found = cl.halving_search(rows, models.RANGES, "held", trials=13, rounds=2)
    assert [f["trial"] for f in found] == list(range(13)) and [f["rung"] for f in found] == [0] * 9 + [1] * 3 + [2]
    assert all(1 <= f["rounds_used"] <= f["rounds_allowed"] == 2 * 3 ** f["rung"] for f in found)
    assert any(f["rounds_used"] < f["rounds_allowed"] for f in found)  # some fits ended early
    first = [f for f in found if f["rung"] == 0]
    carried = max(first, key=lambda f: f["area_roc"])["setting"]
    assert carried in [f["setting"] for f in found if f["rung"] == 1]  # the best goes on
    best = max(found, key=lambda f: f["area_roc"])
    model = cl.boosted_fit(rows, best["setting"], best["rounds_allowed"], "held")
    scored = model.transform(rows.where("held")).select("label", vector_to_array("probability")[1].alias("p")).collect()
    label, p = np.array(scored).T
    assert model.getNumTrees == best["rounds_used"] and abs(area(label, p) - best["area_roc"]) < 1e-6
    assert cl.halving_search(rows, models.RANGES, "held", trials=4, rounds=2)[:3] == cl.halving_search(rows, models.RANGES, "held", trials=4, rounds=2)[:3]


def test_halving_sizes_and_draws():
    assert cl.halving_sizes(96, 3) == [66, 21, 7, 2] and cl.halving_sizes(13, 3) == [9, 3, 1] and cl.halving_sizes(1, 3) == [1]
    wide = cl.drawn(models.RANGES, 200, 1)
    near = cl.drawn(models.RANGES, 200, 1, wide[:1], spread=0.01)
    for name, (least, most, kind) in models.RANGES.items():
        assert all(least <= s[name] <= most for s in wide + near) and len({s[name] for s in wide}) > 4
        assert kind == "int" or np.std([s[name] for s in near]) < np.std([s[name] for s in wide]) / 5


def test_search_within_a_budget(spark):
    """All are tried in ample time; none without time; a fit that goes on is stopped, and what was found before stays."""
    import time

    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    from millrace.operators import budget

    df = spark.range(400).select((F.col("id") % 17).cast("double").alias("x"), (2.0 * (F.col("id") % 17) + F.col("id") % 3).alias("label"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    evaluator = RegressionEvaluator(metricName="rmse")
    plain = [("trees", GBTRegressor(maxDepth=1, maxIter=1, seed=1)), ("strong", LinearRegression(regParam=9.0, solver="normal")), ("free", LinearRegression(solver="normal"))]
    best, found = budget.search(plain, rows, rows, evaluator, 120)
    assert [f["candidate"] for f in found] == ["strong", "free", "trees"] and {f["status"] for f in found} == {"tried"}
    again = {n: evaluator.evaluate(e.fit(rows).transform(rows)) for n, e in plain}
    assert all(f["error"] == pytest.approx(again[f["candidate"]]) for f in found)
    assert evaluator.evaluate(best.transform(rows)) == pytest.approx(min(again.values()))

    best, found = budget.search(plain, rows, rows, evaluator, 0)
    assert best is None and {f["status"] for f in found} == {"not tried"}

    class Endless(LinearRegression):
        def fit(self, data):
            slow = F.udf(lambda x: time.sleep(600) or x, "double")
            return data.select(slow("x")).collect()

    endless = Endless(solver="l-bfgs", maxIter=50)
    start = time.monotonic()
    best, found = budget.search([("endless", endless), ("later", GBTRegressor(maxDepth=5, maxIter=20)), *plain], rows, rows, evaluator, 15, parallelism=1)
    assert time.monotonic() - start < 60 and best is not None
    got = {f["candidate"]: f["status"] for f in found}
    assert got["endless"] == "stopped" and got["later"] == "not tried" and got["free"] == "tried"
    assert spark.range(10).count() == 10

    class Broken(LinearRegression):
        def fit(self, data):
            raise ValueError("broken fit")

    with pytest.raises(ValueError, match="broken fit"):
        budget.search([("broken", Broken(solver="normal"))], rows, rows, evaluator, 60)
