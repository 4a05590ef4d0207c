"""Classification queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.functions.scoring import scoring_function
from millrace.operators import classify as cl
from millrace.operators.documents import spread
from millrace.plans.registry import checked, query

CATEGORICAL = ["lang", "source"]
NUMERIC = ["n_chars", "n_words", "n_lines", "digit_share", "upper_share"]


def _with_measures(documents):
    """Numbers that describe a document's whole text."""
    length = F.greatest(F.length("text"), F.lit(1))
    return spread(documents).select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.regexp_count("text", F.lit(r"\S+")).cast("double").alias("n_words"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
        (F.regexp_count("text", F.lit("[0-9]")) / length).alias("digit_share"),
        (F.regexp_count("text", F.lit("[A-Z]")) / length).alias("upper_share"),
    )


def _labelled(t):
    return _with_measures(t.documents).join(t.labels.select("doc_id", "quality"), "doc_id")


def _prepared(t):
    """Model input, measured and encoded once; the fits then read it many times."""
    space = t.workspace()
    rows = space.keep(_labelled(t), "measured")
    prepared = cl.preparation(CATEGORICAL, NUMERIC, "quality").fit(rows).transform(rows)
    # Files of an even size: every fit starts a task per file, many times over.
    return space.keep(prepared.hint("rebalance"), "prepared")


def _sets(t):
    return cl.hash_split(_prepared(t).select("doc_id", "label", "features"), "doc_id", [70, 30])


def _scored(model, rows):
    return (
        model.transform(rows)
        .withColumn("p", vector_to_array("probability"))
        .select("doc_id", "label", "prediction", F.col("p")[0].alias("prob_0"), F.col("p")[1].alias("prob_1"))
    )


# ---- preparation -----------------------------------------------------------

_INDEX = "row_number() OVER (ORDER BY count(*) DESC, {c}) - 1"


@query(
    "string_index",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, ({_INDEX.format(c=c)})::DOUBLE AS idx, count(*) AS ct "
        f"FROM documents GROUP BY {c}"
        for c in CATEGORICAL
    ),
)
def string_index(t):
    outputs = [f"{c}_index" for c in CATEGORICAL]
    model = StringIndexer(inputCols=CATEGORICAL, outputCols=outputs).fit(t.documents.select(CATEGORICAL))
    indexed = model.transform(t.documents.select(CATEGORICAL))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(f"{c}_index").alias("idx")) for c in CATEGORICAL]
    return indexed.select(F.inline(F.array(*pairs))).groupBy("column_name", "value", "idx").agg(F.count("*").alias("ct"))


@query(
    "one_hot",
    """WITH i AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx FROM documents GROUP BY lang)
       SELECT doc_id, lang, (idx = 0)::INTEGER::DOUBLE AS lang_0, (idx = 1)::INTEGER::DOUBLE AS lang_1,
              (idx = 2)::INTEGER::DOUBLE AS lang_2 FROM documents JOIN i USING (lang)""",
)
def one_hot(t):
    rows = t.documents.select("doc_id", "lang")
    stages = [
        StringIndexer(inputCol="lang", outputCol="lang_index"),
        OneHotEncoder(inputCol="lang_index", outputCol="lang_vector", dropLast=True),
    ]
    encoded = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("v", vector_to_array("lang_vector"))
    return encoded.select("doc_id", "lang", *[F.col("v")[i].alias(f"lang_{i}") for i in range(3)])


@query(
    "feature_vectors",
    r"""WITH d AS (SELECT doc_id, lang, source, text, n_chars, quality FROM documents JOIN labels USING (doc_id)),
        y AS (SELECT quality, row_number() OVER (ORDER BY count(*) DESC, quality) - 1 AS label FROM d GROUP BY 1),
        l AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) AS lang_at FROM d GROUP BY 1),
        s AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS source_at FROM d GROUP BY 1)
       SELECT doc_id, label::DOUBLE AS label, lang_at, source_at, n_chars::DOUBLE AS n_chars,
              len(regexp_extract_all(text, '\S+'))::DOUBLE AS n_words, len(string_split(text, chr(10)))::DOUBLE AS n_lines,
              round(len(regexp_extract_all(text, '[0-9]')) / greatest(length(text), 1), 6) AS digit_share,
              round(len(regexp_extract_all(text, '[A-Z]')) / greatest(length(text), 1), 6) AS upper_share
       FROM d JOIN y USING (quality) JOIN l USING (lang) JOIN s USING (source)""",
)
def feature_vectors(t):
    """The assembled vector taken apart again: encoded categories by position, then the numbers."""
    prepared = _prepared(t)
    names = cl.feature_names(prepared)
    langs = sum(n.startswith("lang") for n in names)
    sources = len(names) - langs - len(NUMERIC)
    v = prepared.withColumn("v", vector_to_array("features"))
    numbers = [F.round(F.element_at("v", i - len(NUMERIC)), 6).alias(n) for i, n in enumerate(NUMERIC)]
    return v.select(
        "doc_id",
        "label",
        F.array_position(F.slice("v", 1, langs), 1.0).alias("lang_at"),
        F.array_position(F.slice("v", langs + 1, sources), 1.0).alias("source_at"),
        *numbers,
    )


@query(
    "split_sets",
    """SELECT part, (SELECT count(*) FROM documents) AS whole, true AS disjoint, true AS near_weight
       FROM (VALUES ('train'), ('validate'), ('test')) AS v(part)""",
)
def split_sets(t):
    """Every document is in exactly one part, and the parts have about their weights."""
    weights = {"train": 60, "validate": 20, "test": 20}
    part = cl.part_of("doc_id", list(weights.values()))
    names = F.array(*[F.struct(F.lit(n).alias("part"), F.lit(w).alias("weight")) for n, w in weights.items()])
    rows = t.documents.select("doc_id", F.get(names, part).alias("p")).select("doc_id", "p.*")
    whole = rows.agg(F.count("*")).scalar()
    distinct = rows.agg(F.count_distinct("doc_id")).scalar()
    counts = rows.groupBy("part", "weight").agg(F.count("*").alias("ct")).withColumns({"whole": whole, "distinct": distinct})
    near = F.abs(F.col("ct") / F.col("whole") - F.col("weight") / 100) < 0.15
    return counts.select("part", "whole", (F.col("whole") == F.col("distinct")).alias("disjoint"), near.alias("near_weight"))


@checked(
    "model_quality",
    """SELECT model, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) AS scored, true AS sums_to_one,
              true AS better_than_chance FROM (VALUES ('logistic'), ('tree'), ('forest'), ('boosted')) AS v(model)""",
    lambda rows: rows.select("model", "scored", "sums_to_one", (F.col("area_roc") > 0.55).alias("better_than_chance")),
)
def model_quality(t):
    """Four models over all labelled documents: rows scored, probabilities and area under the ROC curve."""
    prepared = _prepared(t).select("doc_id", "label", "features")
    estimators = {
        "logistic": LogisticRegression(maxIter=10),
        "tree": DecisionTreeClassifier(maxDepth=3, seed=42),
        "forest": RandomForestClassifier(numTrees=20, seed=42),
        "boosted": GBTClassifier(maxIter=5, seed=42),
    }
    scored = None
    for name, estimator in estimators.items():
        one = _scored(estimator.fit(prepared), prepared).withColumn("model", F.lit(name))
        scored = one if scored is None else scored.unionByName(one)
    kept = t.workspace().keep(scored, "scored")
    areas = cl.areas(cl.roc_points(kept, "prob_1", F.col("label") == 1.0, ["model"]), ["model"])
    sums = kept.groupBy("model").agg(
        F.count("*").alias("scored"), F.bool_and(F.abs(F.col("prob_0") + F.col("prob_1") - 1) < 1e-9).alias("sums_to_one")
    )
    return sums.join(areas, "model").select("model", "scored", "sums_to_one", "area_roc", "area_pr")


@query("binarize", "SELECT p_partkey, p_size, (p_size >= 25)::INTEGER AS is_large FROM part")
def binarize(t):
    return t.part.select("p_partkey", "p_size", (F.col("p_size") >= 25).cast("int").alias("is_large"))


# ---- models ----------------------------------------------------------------

# The same split in SQL: the first 32 bits of md5 of seed and key, modulo the weights' sum.
def _bucket_sql(key: str, weights: int = 100) -> str:
    return f"(('0x' || md5('42:' || {key})[1:8])::BIGINT % {weights})"


_LABELLED = """l AS (SELECT doc_id, quality, lang, source FROM documents JOIN labels USING (doc_id)),
    y AS (SELECT quality, row_number() OVER (ORDER BY count(*) DESC, quality) - 1 AS label FROM l GROUP BY 1)"""
_TEST_ROWS = f"""WITH {_LABELLED} SELECT doc_id, label::DOUBLE AS label, true AS proper FROM l JOIN y USING (quality)
    WHERE {_bucket_sql("doc_id")} >= 70"""


def _proper(scored, *more):
    """Rows with a check of their numbers: probabilities in [0, 1] that sum to one, and the likelier class predicted."""
    sums = F.abs(F.col("prob_0") + F.col("prob_1") - 1) < 1e-9
    inside = F.col("prob_0").between(0, 1) & F.col("prob_1").between(0, 1)
    likelier = F.col("prediction") == F.when(F.col("prob_1") > F.col("prob_0"), 1.0).otherwise(0.0)
    even = F.abs(F.col("prob_1") - F.col("prob_0")) < 1e-12
    return scored.select("doc_id", "label", (sums & inside & (likelier | even)).alias("proper"), *more)


@checked("logreg_scores", _TEST_ROWS, _proper)
def logreg_scores(t):
    train, test = _sets(t)
    return _scored(LogisticRegression(maxIter=10).fit(train), test)


_FEATURES = f"""f AS (SELECT 'lang_vector_' || lang AS feature FROM l UNION SELECT 'source_vector_' || source FROM l
    UNION {" UNION ".join(f"SELECT '{n}'" for n in NUMERIC)})"""


@checked(
    "logreg_coefficients",
    f"WITH {_LABELLED}, {_FEATURES} SELECT feature, true AS finite FROM f UNION ALL SELECT '(intercept)', true",
    lambda rows: rows.select("feature", (F.abs("weight") < float("inf")).alias("finite")),
)
def logreg_coefficients(t):
    prepared = _prepared(t)
    train, _ = cl.hash_split(prepared, "doc_id", [70, 30])
    model = LogisticRegression(maxIter=10).fit(train)
    return t.spark.createDataFrame(cl.coefficients(model, cl.feature_names(prepared)), "feature string, weight double")


@checked(
    "tree_scores",
    _TEST_ROWS.replace("true AS proper", "true AS proper, true AS shallow, 'gini' AS impurity"),
    lambda rows: _proper(rows, ((F.col("depth") <= 3) & (F.col("nodes") <= 15)).alias("shallow"), "impurity"),
)
def tree_scores(t):
    train, test = _sets(t)
    model = DecisionTreeClassifier(maxDepth=3, seed=42).fit(train)
    shape = {"depth": F.lit(model.depth), "nodes": F.lit(model.numNodes), "impurity": F.lit(model.getOrDefault("impurity"))}
    return _scored(model, test).withColumns(shape)


@checked("forest_scores", _TEST_ROWS, _proper)
def forest_scores(t):
    train, test = _sets(t)
    return _scored(RandomForestClassifier(numTrees=20, seed=42).fit(train), test)


def _importance_flags(rows):
    total = rows.agg(F.sum("importance")).scalar()
    return rows.select("feature", F.col("importance").between(0, 1).alias("inside"), (F.abs(total - 1) < 1e-9).alias("sum_is_one"))


@checked(
    "feature_importance",
    f"WITH {_LABELLED}, {_FEATURES} SELECT feature, true AS inside, true AS sum_is_one FROM f",
    _importance_flags,
)
def feature_importance(t):
    prepared = _prepared(t)
    train, _ = cl.hash_split(prepared, "doc_id", [70, 30])
    model = RandomForestClassifier(numTrees=20, seed=42).fit(train)
    return t.spark.createDataFrame(cl.importances(model, cl.feature_names(prepared)), "feature string, importance double")


@checked(
    "prediction_counts",
    f"""WITH {_LABELLED} SELECT 'quality' AS by, quality::VARCHAR AS value, count(*) AS ct, true AS known FROM l GROUP BY quality
        UNION ALL SELECT 'lang', lang, count(*), true FROM l GROUP BY lang""",
    lambda rows: rows.groupBy("by", "value").agg(F.sum("ct").alias("ct"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("known")),
)
def prediction_counts(t):
    """How often each prediction was made, by class and by language."""
    prepared = _prepared(t)
    train, _ = cl.hash_split(prepared, "doc_id", [70, 30])
    model = RandomForestClassifier(numTrees=20, seed=42).fit(train.select("doc_id", "label", "features"))
    pairs = F.array(
        F.struct(F.lit("quality").alias("by"), F.col("quality").cast("string").alias("value")),
        F.struct(F.lit("lang").alias("by"), F.col("lang").alias("value")),
    )
    return model.transform(prepared).select("prediction", F.inline(pairs)).groupBy("by", "value", "prediction").agg(F.count("*").alias("ct"))


def _metrics(t, rows):
    """The searched settings and their areas, best first."""
    return t.spark.createDataFrame(rows, "params string, area_roc double").orderBy(F.desc("area_roc"), "params")


def _areas_inside(rows):
    return rows.select("params", F.col("area_roc").between(0, 1).alias("inside"))


def _grid_sql(grid: dict) -> str:
    """The grid's settings as SQL rows: one cross join of value lists, as text in order of the names."""
    names = sorted(grid)
    values = [", ".join(f"('{v}')" for v in grid[n]) for n in names]
    lists = ", ".join(f"(VALUES {v}) AS v{i}({n})" for i, (n, v) in enumerate(zip(names, values)))
    text = " || ', ' || ".join(f"'{n}=' || {n}" for n in names)
    return f"SELECT {text} AS params, true AS inside FROM {lists}"


# The grids searched.
GRID_LOGISTIC = {"regParam": [0.01, 0.5, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [1, 5, 10]}
GRID_TREE = {"maxDepth": [1, 2, 6, 10], "maxBins": [20, 40, 80]}
GRID_FOREST = {"maxDepth": [2, 4, 6], "maxBins": [20, 60], "numTrees": [5, 20]}
GRID_SWEEP = {"maxDepth": [1, 2, 3, 4], "stepSize": [0.05, 0.1, 0.2, 0.3], "subsamplingRate": [0.6, 0.8, 1.0], "maxIter": [2, 4]}


@checked("cv_grid", _grid_sql(GRID_LOGISTIC), _areas_inside)
def cv_grid(t):
    train, _ = _sets(t)
    _, rows = cl.tune(LogisticRegression(), GRID_LOGISTIC, train)
    return _metrics(t, rows)


@checked("cv_tree", _grid_sql(GRID_TREE), _areas_inside)
def cv_tree(t):
    train, _ = _sets(t)
    _, rows = cl.tune(DecisionTreeClassifier(seed=42), GRID_TREE, train)
    return _metrics(t, rows)


@checked("cv_forest", _grid_sql(GRID_FOREST), _areas_inside)
def cv_forest(t):
    train, _ = _sets(t)
    _, rows = cl.tune(RandomForestClassifier(seed=42), GRID_FOREST, train)
    return _metrics(t, rows)


@checked("gbt_sweep", _grid_sql(GRID_SWEEP), _areas_inside)
def gbt_sweep(t):
    """96 settings on one train and validation split."""
    train, _ = _sets(t)
    _, rows = cl.sweep(GBTClassifier(seed=42), GRID_SWEEP, train)
    return _metrics(t, rows)


# Ranges of the adaptive search: least, most, and how values spread between them.
RANGES = {"maxDepth": (1, 5, "int"), "stepSize": (0.02, 0.5, "log"), "subsamplingRate": (0.5, 1.0, "float"), "minInstancesPerNode": (1, 20, "int")}


def _halving_flags(rows):
    sound = F.col("area_roc").between(0, 1) & (F.col("rounds_used") >= 1) & (F.col("rounds_used") <= F.col("rounds_allowed"))
    inside = [F.col(n).between(least, most) for n, (least, most, _) in RANGES.items()]
    for condition in inside:
        sound = sound & condition
    return rows.groupBy("rung", "rounds_allowed").agg(F.count("*").alias("trials"), F.bool_and(sound).alias("sound"))


@checked(
    "gbt_halving",
    """SELECT rung, (2 * 3 ** rung)::INTEGER AS rounds_allowed, trials, true AS sound
       FROM (VALUES (0, 66::BIGINT), (1, 21), (2, 7), (3, 2)) AS v(rung, trials), (SELECT count(*) FROM labels) AS l""",
    _halving_flags,
)
def gbt_halving(t):
    """96 trials of boosted trees: settings of a rung follow from the one before, and rounds stop on held-out rows."""
    train, _ = _sets(t)
    space = t.workspace()
    rows = space.keep(train.withColumn("held", cl.part_of("doc_id", [80, 20], seed=7) == 1), "trials")
    found = cl.halving_search(rows, RANGES, "held")
    schema = "trial int, rung int, maxDepth int, stepSize double, subsamplingRate double, minInstancesPerNode int, rounds_allowed int, rounds_used int, area_roc double"
    made = [{**{k: v for k, v in f.items() if k != "setting"}, **f["setting"]} for f in found]
    return t.spark.createDataFrame(made, schema)


@checked("batch_score", "SELECT doc_id, true AS proper FROM documents", lambda rows: _proper(rows.withColumn("label", F.lit(0))).drop("label"))
def batch_score(t):
    """The best model of a search, kept, loaded and applied to every document."""
    space = t.workspace()
    measured = space.keep(_with_measures(t.documents), "measured")
    train, _ = cl.hash_split(measured.join(t.labels.select("doc_id", "quality"), "doc_id"), "doc_id", [70, 30])
    train = space.keep(train, "train")
    prepare = cl.preparation(CATEGORICAL, NUMERIC, None).fit(train)
    ready = space.keep(prepare.transform(train).withColumn("label", F.col("quality").cast("double")), "ready")
    search, _ = cl.tune(RandomForestClassifier(seed=42), {"maxDepth": [2, 5], "numTrees": [5, 20]}, ready, folds=2)
    path = space.path("model")
    PipelineModel([*prepare.stages, search.bestModel]).write().save(path)
    scored = PipelineModel.load(path).transform(measured).withColumn("p", vector_to_array("probability"))
    return scored.select("doc_id", "prediction", F.col("p")[0].alias("prob_0"), F.col("p")[1].alias("prob_1"))


def _class_flags(scored):
    """Each probability in [0, 1], their sum one, the predicted class the likeliest and under its name."""
    classes = [c for c in scored.columns if c.startswith("prob_")]
    values = F.array(*classes)
    sums = F.abs(F.aggregate(values, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9
    likeliest = F.element_at(values, F.col("prediction").cast("int") + 1) == F.array_max(values)
    named = F.col("predicted") == F.concat(F.lit("class_"), F.col("prediction").cast("int"))
    inside = F.forall(values, lambda x: x.between(0, 1))
    return scored.select("vec_id", "label", (sums & likeliest & named & inside).alias("proper"))


@checked(
    "prob_columns",
    f"""SELECT vec_id, label::DOUBLE AS label, true AS proper FROM embeddings WHERE {_bucket_sql("vec_id")} >= 70""",
    _class_flags,
)
def prob_columns(t):
    """A probability column per class and the predicted class by name."""
    rows = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features"))
    train, test = cl.hash_split(rows, "vec_id", [70, 30])
    model = RandomForestClassifier(numTrees=20, seed=42).fit(train)
    classes = [f"class_{i}" for i in range(model.numClasses)]
    scored = cl.probability_columns(model.transform(test), classes)
    return scored.select("vec_id", "label", "prediction", "predicted", *[f"prob_{c}" for c in classes])


def _forest_pipeline(t, space):
    """Measured documents and a fitted pipeline from their columns to a forest's scores."""
    measured = space.keep(_with_measures(t.documents), "measured")
    train, _ = cl.hash_split(measured.join(t.labels.select("doc_id", "quality"), "doc_id"), "doc_id", [70, 30])
    train = space.keep(train.withColumn("label", F.col("quality").cast("double")), "train")
    stages = [*cl.preparation(CATEGORICAL, NUMERIC).getStages(), RandomForestClassifier(numTrees=20, seed=42)]
    return measured, Pipeline(stages=stages).fit(train)


@query("struct_score")
def struct_score(t):
    """A forest as a function over a struct of columns, used from SQL."""
    measured, model = _forest_pipeline(t, t.workspace())
    t.spark.udf.register("millrace_quality", scoring_function(t.spark, model))
    columns = ", ".join([*CATEGORICAL, *NUMERIC])
    scored = t.spark.sql(f"SELECT doc_id, millrace_quality(struct({columns})) AS s FROM {{rows}}", rows=measured)
    p = F.col("s.probability")
    return scored.select("doc_id", "s.prediction", p[0].alias("prob_0"), p[1].alias("prob_1"))


@query("struct_score_check", "SELECT doc_id, true AS same_prediction, true AS same_probability FROM documents")
def struct_score_check(t):
    """The function's scores next to those of the pipeline's own transform, row by row."""
    measured, model = _forest_pipeline(t, t.workspace())
    score = scoring_function(t.spark, model)
    both = model.transform(measured.withColumn("s", score(F.struct(*CATEGORICAL, *NUMERIC)))).withColumn("p", vector_to_array("probability"))
    near = F.forall(F.zip_with("p", "s.probability", lambda a, b: F.abs(a - b) < 1e-12), lambda x: x)
    return both.select("doc_id", (F.col("prediction") == F.col("s.prediction")).alias("same_prediction"), near.alias("same_probability"))


# ---- curves ----------------------------------------------------------------

_POINTS = """p AS (SELECT l_linestatus, {score} AS threshold, count(*) FILTER (l_returnflag = 'R') AS pos,
                         count(*) FILTER (l_returnflag <> 'R') AS neg FROM lineitem GROUP BY ALL),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS positives, sum(neg) OVER a AS negatives
          FROM p WINDOW w AS (PARTITION BY l_linestatus ORDER BY threshold DESC), a AS (PARTITION BY l_linestatus))"""


@query(
    "roc_curve",
    f"""WITH {_POINTS.format(score="l_quantity")}
        SELECT l_linestatus, threshold, round(fp / negatives, 6) AS fpr, round(tp / positives, 6) AS tpr,
               round(tp / (tp + fp), 6) AS "precision" FROM c""",
)
def roc_curve(t):
    points = cl.roc_points(t.lineitem, "l_quantity", F.col("l_returnflag") == "R", ["l_linestatus"])
    return points.select("l_linestatus", "threshold", *[F.round(c, 6).alias(c) for c in ("fpr", "tpr", "precision")])


@query(
    "auc_by_group",
    f"""WITH {_POINTS.format(score="l_extendedprice")}, s AS (
          SELECT *, (tp - pos) / nullif(tp + fp - pos - neg, 0) AS earlier FROM c)
        SELECT l_linestatus, round(sum(neg * (2 * tp - pos) / (2.0 * positives * negatives)), 6) AS area_roc,
               round(sum(pos / positives * (tp / (tp + fp) + coalesce(earlier, tp / (tp + fp))) / 2), 6) AS area_pr
        FROM s GROUP BY 1""",
)
def auc_by_group(t):
    points = cl.roc_points(t.lineitem, "l_extendedprice", F.col("l_returnflag") == "R", ["l_linestatus"])
    return cl.areas(points, ["l_linestatus"]).withColumns({c: F.round(c, 6) for c in ("area_roc", "area_pr")})


@query("auc_crosscheck", "SELECT true AS same_roc, true AS same_pr FROM (SELECT count(*) FROM lineitem)")
def auc_crosscheck(t):
    """The exact areas against MLlib's evaluator, with as many bins as there are scores."""
    rows = t.lineitem.select(F.col("l_quantity").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    own = cl.areas(cl.roc_points(rows, "score", F.col("label") == 1.0))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    roc = evaluator.setMetricName("areaUnderROC").evaluate(rows)
    pr = evaluator.setMetricName("areaUnderPR").evaluate(rows)
    return own.select(
        (F.abs(F.col("area_roc") - roc) < 1e-6).alias("same_roc"), (F.abs(F.col("area_pr") - pr) < 1e-6).alias("same_pr")
    )
