"""A fitted model as a function of a struct, for SELECT lists, SQL and streams.

The stages of a fitted pipeline are read out into plain arrays once, on the
driver; these travel to the tasks as a broadcast (their size is the model's)
and score whole Arrow batches with NumPy. So rows need not pass the pipeline's
own columns, and a stream or a SQL text can use the model like any function.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import functions as F

SCORE = "struct<prediction:double,probability:array<double>>"


@dataclass
class Tree:
    """Nodes as arrays: a split sends a row left if its value is at most the threshold, or among the categories."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    categories: list[frozenset | None] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaf: list[list[float] | None] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    @classmethod
    def read(cls, root) -> Tree:
        """From a tree model's root node; nodes are numbered in the order they are met."""
        tree, open_ = cls(), [(root, None, None)]
        while open_:
            node, parent, side = open_.pop()
            at = len(tree.feature)
            if parent is not None:
                getattr(tree, side)[parent] = at
            inner = node.getClass().getSimpleName() == "InternalNode"
            split = node.split() if inner else None
            listed = inner and split.getClass().getSimpleName() == "CategoricalSplit"
            tree.feature.append(split.featureIndex() if inner else -1)
            tree.threshold.append(0.0 if listed or not inner else split.threshold())
            tree.categories.append(frozenset(split.leftCategories()) if listed else None)
            tree.left.append(-1)
            tree.right.append(-1)
            tree.leaf.append(None if inner else list(node.impurityStats().stats()))
            tree.value.append(node.prediction())
            if inner:
                open_ += [(node.leftChild(), at, "left"), (node.rightChild(), at, "right")]
        return tree

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, one level of the tree at a time."""
        at = np.zeros(len(x), dtype=np.int64)
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        threshold = np.array(self.threshold)
        while True:
            rows = np.flatnonzero(feature[at] >= 0)
            if not len(rows):
                return at
            node = at[rows]
            values = x[rows, feature[node]]
            goes_left = values <= threshold[node]
            for n in np.unique(node):
                if self.categories[n] is not None:
                    mine = node == n
                    goes_left[mine] = np.isin(values[mine], list(self.categories[n]))
            at[rows] = np.where(goes_left, left[node], right[node])

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Class shares of each row's leaf."""
        counts = np.array([c or [0.0] * self.classes for c in self.leaf])
        total = counts.sum(axis=1, keepdims=True)
        return np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)[self.leaves(x)]

    @property
    def classes(self) -> int:
        return max(len(c) for c in self.leaf if c is not None)


class Scorer:
    """The stages of a fitted pipeline as plain Python, from columns to probabilities."""

    def __init__(self, model: PipelineModel):
        self.indexes: dict[str, tuple[str, dict[str, int]]] = {}
        self.encodings: dict[str, tuple[str, int]] = {}
        self.inputs: list[str] = []
        self.kind, self.trees, self.weights = "", [], None
        for stage in model.stages:
            if isinstance(stage, StringIndexerModel):
                outs = stage.getOutputCols() if stage.isSet(stage.outputCols) else [stage.getOutputCol()]
                ins = stage.getInputCols() if stage.isSet(stage.inputCols) else [stage.getInputCol()]
                if stage.getHandleInvalid() != "keep":
                    raise ValueError("an indexer must keep unknown values: a scoring function has to score every row")
                for source, out, labels in zip(ins, outs, stage.labelsArray, strict=True):
                    self.indexes[out] = (source, {label: i for i, label in enumerate(labels)})
            elif isinstance(stage, OneHotEncoderModel):
                for source, out, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes, strict=True):
                    self.encodings[out] = (source, size - 1 if stage.getDropLast() else size)
            elif isinstance(stage, VectorAssembler):
                self.inputs = stage.getInputCols()
            elif isinstance(stage, LogisticRegressionModel):
                self.kind = "logistic"
                self.weights = (stage.coefficientMatrix.toArray(), stage.interceptVector.toArray(), stage.getThreshold() if stage.numClasses == 2 else None)
            elif isinstance(stage, (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)):
                self.kind = "boosted" if isinstance(stage, GBTClassificationModel) else "forest"
                java = stage._java_obj
                trees = list(java.trees()) if not isinstance(stage, DecisionTreeClassificationModel) else [java]
                self.trees = [Tree.read(t.rootNode()) for t in trees]
                self.weights = np.array(list(java.treeWeights())) if len(trees) > 1 or self.kind == "boosted" else np.ones(1)
            else:
                raise ValueError(f"no scoring form of {type(stage).__name__}")
        if not self.kind:
            raise ValueError("the pipeline ends without a classifier")

    @property
    def columns(self) -> list[str]:
        """The source columns that a scored struct must hold."""
        names = []
        for name in self.inputs:
            name = self.encodings.get(name, (name,))[0]
            names.append(self.indexes.get(name, (name,))[0])
        return list(dict.fromkeys(names))

    def features(self, frame: pd.DataFrame) -> np.ndarray:
        parts = []
        for name in self.inputs:
            source, width = self.encodings.get(name, (name, None))
            if source in self.indexes:
                column, known = self.indexes[source]
                values = frame[column].map(known).fillna(len(known)).to_numpy(dtype=np.int64)
            else:
                values = frame[source].to_numpy(dtype=np.float64)
            if width is None:
                parts.append(values[:, None].astype(np.float64))
            else:
                parts.append((values[:, None] == np.arange(width)).astype(np.float64))
        return np.hstack(parts) if parts else np.zeros((len(frame), 0))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.kind == "logistic":
            matrix, intercepts, _ = self.weights
            margin = x @ matrix.T + intercepts
            if matrix.shape[0] == 1:
                p = 1 / (1 + np.exp(-margin[:, 0]))
                return np.stack([1 - p, p], axis=1)
            e = np.exp(margin - margin.max(axis=1, keepdims=True))
            return e / e.sum(axis=1, keepdims=True)
        if self.kind == "boosted":
            margin = sum(w * np.array(t.value)[t.leaves(x)] for w, t in zip(self.weights, self.trees, strict=True))
            p = 1 / (1 + np.exp(-2 * margin))
            return np.stack([1 - p, p], axis=1)
        votes = sum(t.shares(x) for t in self.trees)
        return votes / votes.sum(axis=1, keepdims=True)

    def score(self, frame: pd.DataFrame) -> pd.DataFrame:
        """Prediction and probabilities per row; a row with a null number has neither."""
        x = self.features(frame)
        whole = ~np.isnan(x).any(axis=1)
        p = self.probabilities(np.where(np.isnan(x), 0.0, x))
        best = p.argmax(axis=1).astype(np.float64)
        if self.kind == "logistic" and self.weights[2] is not None:
            best = (p[:, 1] > self.weights[2]).astype(np.float64)
        scores = [list(map(float, row)) if ok else None for row, ok in zip(p, whole, strict=True)]
        return pd.DataFrame({"prediction": pd.Series(best).where(whole), "probability": pd.Series(scores, dtype=object)})


def scoring_function(spark, model: PipelineModel):
    """``f(struct(*columns))`` that gives the model's prediction and probabilities; see :data:`SCORE`.

    One set-up per task, then batch after batch. Register it under a name for
    SQL with ``spark.udf.register(name, f)``.
    """
    # With its code, so that workers need not have this package installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(Scorer(model)))

    @F.pandas_udf(SCORE)
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = pickle.loads(shared.value)
        for frame in batches:
            yield scorer.score(frame)

    return score
