"""Binary classification: preparation, models, tuning, ROC and scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals
from millrace.session import Workspace


def preparation(categorical: Sequence[str], numeric: Sequence[str], label: str | None = None) -> Pipeline:
    """Index and encode the categories, index the label, gather one feature vector.

    The indexer holds every category on the driver, so ``categorical`` takes
    columns of few values only (thousands, not ids).
    """
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_vector" for c in categorical]
    stages = [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*encoded, *numeric], outputCol="features"),
    ]
    if label:
        stages.append(StringIndexer(inputCol=label, outputCol="label"))
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries, from the metadata its stages left."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    return [named[i] for i in sorted(named)]


def part_of(key: str, weights: Sequence[int], seed: int = 42) -> Column:
    """Index of the part of ``weights`` that a row's key falls into.

    The bucket is the first 32 bits of the md5 of seed and key, so any engine
    can state it. Unlike ``randomSplit`` a row lands in the same part whatever
    the file layout, partitioning or retries.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % sum(weights)
    ends = [sum(weights[: i + 1]) for i in range(len(weights) - 1)]
    return sum((F.when(bucket >= e, 1).otherwise(0) for e in ends), F.lit(0))


def hash_split(df: DataFrame, key: str, weights: Sequence[int], seed: int = 42) -> list[DataFrame]:
    """Disjoint parts by a hash of the key."""
    part = part_of(key, weights, seed)
    return [df.where(part == i) for i in range(len(weights))]


def coefficients(model, names: Sequence[str]) -> list[tuple[str, float]]:
    return [("(intercept)", float(model.intercept)), *zip(names, map(float, model.coefficients))]


def importances(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Features by falling importance."""
    return sorted(zip(names, map(float, model.featureImportances.toArray())), key=lambda p: (-p[1], p[0]))


def probability_columns(scored: DataFrame, classes: Sequence[str], vector: str = "probability") -> DataFrame:
    """One column per class probability and the predicted class by name."""
    values = vector_to_array(vector)
    named = F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int") + 1)
    return scored.withColumns({f"prob_{c}": values[i] for i, c in enumerate(classes)}).withColumn("predicted", named)


def _grid(estimator, grid: dict):
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def _named(maps, metrics) -> list[tuple[str, float]]:
    text = lambda m: ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name))
    return [(text(m), float(metric)) for m, metric in zip(maps, metrics)]


def tune(estimator, grid: dict, train: DataFrame, folds: int = 5, parallelism: int = 8, seed: int = 42):
    """Cross-validate a grid ``{param name: values}``; returns the fitted search, which holds the best model, and its rows."""
    maps = _grid(estimator, grid)
    settings = {"estimator": estimator, "estimatorParamMaps": maps, "evaluator": BinaryClassificationEvaluator()}
    search = CrossValidator(numFolds=folds, parallelism=parallelism, seed=seed, **settings).fit(train)
    return search, _named(maps, search.avgMetrics)


def sweep(estimator, grid: dict, train: DataFrame, ratio: float = 0.8, parallelism: int = 10, seed: int = 42):
    """Search a grid on one train and validation split; returns as :func:`tune` does."""
    maps = _grid(estimator, grid)
    settings = {"estimator": estimator, "estimatorParamMaps": maps, "evaluator": BinaryClassificationEvaluator()}
    search = TrainValidationSplit(trainRatio=ratio, parallelism=parallelism, seed=seed, **settings).fit(train)
    return search, _named(maps, search.validationMetrics)


def halving_sizes(trials: int, eta: int) -> list[int]:
    """Settings per rung, ``trials`` in sum: each rung has one in ``eta`` of the one before."""

    def rungs(first: int) -> list[int]:
        sizes = [first]
        while sizes[-1] >= eta:
            sizes.append(sizes[-1] // eta)
        return sizes

    first = next(n for n in range(trials, 0, -1) if sum(rungs(n)) <= trials)
    sizes = rungs(first)
    return [sizes[0] + trials - sum(sizes), *sizes[1:]]


def drawn(ranges: dict, count: int, seed: int, around: Sequence[dict] = (), spread: float = 0.15) -> list[dict]:
    """Settings from continuous ranges ``{name: (least, most, kind)}``, kind being ``float``, ``int`` or ``log``.

    With settings to search ``around``, each draw moves one of them, in turn,
    by a normal step of ``spread`` of the range.
    """
    r = random.Random(seed)
    made = []
    for i in range(count):
        setting = {}
        for name, (least, most, kind) in sorted(ranges.items()):
            low, high = (math.log(least), math.log(most)) if kind == "log" else (least, most)
            if around:
                at = around[i % len(around)][name]
                place = (math.log(at) if kind == "log" else at) + r.gauss(0, spread * (high - low))
            else:
                place = r.uniform(low, high)
            place = min(high, max(low, place))
            setting[name] = math.exp(place) if kind == "log" else int(round(place)) if kind == "int" else place
        made.append(setting)
    return made


def boosted_fit(rows: DataFrame, setting: dict, rounds: int, held: str, patience: float = 0.005, seed: int = 42):
    """Boosted trees of at most ``rounds`` rounds; they stop when the rows marked by ``held`` gain nothing more."""
    booster = GBTClassifier(maxIter=rounds, validationIndicatorCol=held, validationTol=patience, seed=seed)
    return booster.copy({booster.getParam(n): v for n, v in setting.items()}).fit(rows)


def halving_search(
    rows: DataFrame, ranges: dict, held: str, trials: int = 96, eta: int = 3, rounds: int = 2, refine: float = 0.5, parallelism: int = 10, seed: int = 42
) -> list[dict]:
    """Successive halving of boosted trees over continuous ranges, with early stopping in each fit.

    The first rung is fitted with few rounds, and each next one with ``eta``
    times as many. Of its settings a share of ``refine`` moves the best of the
    rung before a little, and the rest are these best themselves; so later
    settings follow from earlier results. ``rows`` hold ``features``, ``label``
    and the column ``held``, true for rows that judge and end a fit. Returns a
    record per trial, in order: rung, setting, rounds allowed and used, area
    under the ROC curve of the held rows. All draws follow from ``seed``.
    """
    judged, evaluator = rows.where(held), BinaryClassificationEvaluator()
    done: list[dict] = []
    best: list[dict] = []
    for rung, size in enumerate(halving_sizes(trials, eta)):
        moved = 0 if not best else int(size * refine) if size > 1 else 0
        settings = [b["setting"] for b in best[: size - moved]] + drawn(ranges, size - len(best[: size - moved]), seed + rung, [b["setting"] for b in best])
        allowed = rounds * eta**rung

        def fit(setting, rung=rung, allowed=allowed):
            model = boosted_fit(rows, setting, allowed, held, seed=seed)
            area = evaluator.evaluate(model.transform(judged))
            return {"rung": rung, "setting": setting, "rounds_allowed": allowed, "rounds_used": model.getNumTrees, "area_roc": area}

        with ThreadPool(parallelism) as pool:  # as CrossValidator does: the fits are Spark jobs
            fitted = pool.map(inheritable_thread_target(rows.sparkSession)(fit), settings)
        done += [{"trial": len(done) + i, **f} for i, f in enumerate(fitted)]
        best = sorted(done[-size:], key=lambda f: (-f["area_roc"], f["trial"]))
    return done


def roc_points(df: DataFrame, score: str, positive: Column, keys: Sequence[str] = ()) -> DataFrame:
    """One ROC and precision-recall point per distinct score, highest first.

    Scores are counted, written and then accumulated by range,
    so every threshold is kept and no group is walked through by one task.
    """
    counted = df.groupBy(*keys, score).agg(F.count_if(positive).alias("_pos"), F.count("*").alias("_n"))
    counted = Workspace(df.sparkSession).keep(counted, "score-counts")
    totals = {"tp": F.col("_pos"), "fp": F.col("_n") - F.col("_pos")}
    points = running_totals(counted, list(keys), score, score, totals, whole=True, descending=True)
    return points.select(
        *keys,
        F.col(score).alias("threshold"),
        F.col("_pos").alias("pos"),
        (F.col("_n") - F.col("_pos")).alias("neg"),
        "tp",
        "fp",
        F.try_divide("fp", "fp_whole").alias("fpr"),
        F.try_divide("tp", "tp_whole").alias("tpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.col("tp_whole").alias("positives"),
        F.col("fp_whole").alias("negatives"),
    )


def areas(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Areas under the ROC and precision-recall curves, by trapezoids.

    A point knows its predecessor, since it holds both the running counts and
    its own, so no ordering is needed here.
    """
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    roc = F.try_divide(neg * (2 * tp - pos), 2.0 * F.col("positives") * F.col("negatives"))
    before = tp + fp - pos - neg
    earlier = F.coalesce(F.try_divide(tp - pos, before), F.col("precision"))
    pr = F.try_divide(pos, F.col("positives")) * (F.col("precision") + earlier) / 2
    sums = [F.sum(roc).alias("area_roc"), F.sum(pr).alias("area_pr")]
    return points.groupBy(*keys).agg(*sums) if keys else points.agg(*sums)
