"""Quality by a vote of the nearest labelled documents in a latent-semantic space.

A document is a sparse row: log term counts times idf, hashed into ``BUCKETS``
columns, next to a few columns of shape (share of symbols, repeats, digits,
length and so on, each spread over soft bins). Both halves have length one. A
truncated SVD of the labelled rows (randomised range finder, two power steps)
gives ``RANK`` latent directions. The labelled vectors, at most ``SAMPLE`` x
``RANK`` numbers, are broadcast; every document's cosines with all of them are
computed exactly, block by block; the ``NEIGHBOURS`` largest vote with their
similarity, against a weak prior.

The model is fitted on at most ``SAMPLE`` labelled documents, the ones whose
ids have the least hash. Labels serve the vote only; language, source and id
are never part of a row.

Defined results: null and empty texts are rows without terms and get a score
like any other; repeated rows agree; without labels every score is 0.5; a
document labelled twice counts with its lower label.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts
from millrace.llm.quality_rules import Text

TERM = re.compile(r"[^\W_]+|[^\w\s]|_")
BUCKETS = 1 << 15
BINS = 8
SHAPES = 8
WIDTH = BUCKETS + SHAPES * BINS
RANK = 48
SAMPLE = 4000
NEIGHBOURS = 31
BLOCK = 1024
#: Votes sharpen with this power of the cosine; the prior counts as much as one neighbour of cosine 0.5.
POWER = 8
KNOWN_TERMS = 300_000


def shapes(t: Text) -> list[float]:
    """Numbers from 0 to 1 that describe a text's form."""
    n, chars = max(1, len(t.words)), max(1, t.word_chars)
    lines = max(1, len(t.lines))
    digits = len(t.data) - len(t.data.translate(None, b"0123456789"))
    marks = len(t.data) - len(t.data.translate(None, b".,;:!?\"'()-"))
    return [
        min(1.0, math.log1p(len(t.words)) / 8),
        min(1.0, 6 * t.symbols / chars),
        min(1.0, 2 * t.repeat_words / n),
        min(1.0, 2 * t.dup_lines / lines),
        min(1.0, chars / n / 16),
        min(1.0, 5 * digits / chars),
        min(1.0, 5 * marks / chars),
        len(set(t.words)) / n if t.words else 0.0,
    ]


class Rows:
    """Sparse rows of texts; buckets of terms are remembered up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def terms(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns and log counts of a text's terms."""
        counts = Counter(TERM.findall((text or "").lower()))
        known = self.known
        if len(known) > KNOWN_TERMS:
            known.clear()
        for w in [w for w in counts if w not in known]:
            known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
        at = np.array([known[w] for w in counts], dtype=np.int32)
        return at, np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))

    def form(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights of a text's shape, two neighbouring bins for each number."""
        x = np.array(shapes(Text(text))) * (BINS - 1)
        low = np.minimum(x.astype(np.int32), BINS - 2)
        base = BUCKETS + np.arange(SHAPES) * BINS + low
        weight = np.concatenate([1 - (x - low), x - low])
        return np.concatenate([base, base + 1]).astype(np.int32), (weight / np.linalg.norm(weight)).astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray
    directions: np.ndarray  # [WIDTH, rank]
    vectors: np.ndarray  # [labelled, rank], length one
    labels: np.ndarray
    prior: float


def weighted(idf: np.ndarray, at: np.ndarray, logs: np.ndarray) -> np.ndarray:
    w = logs * idf[at]
    norm = float(np.linalg.norm(w))
    return w / norm if norm else w


def project(rows: list[tuple[np.ndarray, np.ndarray]], directions: np.ndarray) -> np.ndarray:
    """Product of sparse rows with a dense matrix, in blocks; no row is empty, as each has its shape."""
    out = np.empty((len(rows), directions.shape[1]), dtype=np.float32)
    for lo in range(0, len(rows), 256):
        part = rows[lo : lo + 256]
        ends = np.cumsum([0] + [len(a) for a, _ in part][:-1])
        flat = directions[np.concatenate([a for a, _ in part])] * np.concatenate([w for _, w in part])[:, None]
        out[lo : lo + 256] = np.add.reduceat(flat, ends, axis=0)
    return out


def project_back(rows: list[tuple[np.ndarray, np.ndarray]], dense: np.ndarray) -> np.ndarray:
    """Product of the transposed sparse rows with a dense matrix."""
    out = np.zeros((WIDTH, dense.shape[1]), dtype=np.float32)
    at = np.concatenate([a for a, _ in rows])
    weight = np.concatenate([w for _, w in rows])
    owner = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    for k in range(dense.shape[1]):
        out[:, k] = np.bincount(at, weights=weight * dense[owner, k], minlength=WIDTH)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def fit(sample: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]], rank: int = RANK, seed: int = 3) -> Model | None:
    """``sample`` rows: term columns, log counts, shape columns, shape weights, label."""
    if not sample:
        return None
    df = np.bincount(np.concatenate([np.unique(at) for at, *_ in sample]), minlength=BUCKETS)
    idf = np.log((1 + len(sample)) / (1 + df)).astype(np.float32) + np.float32(0.1)
    rows = [(np.concatenate([at, form]), np.concatenate([weighted(idf, at, logs), w])) for at, logs, form, w, _ in sample]
    rank = min(rank, len(rows))
    basis = np.random.default_rng(seed).standard_normal((WIDTH, min(len(rows), rank + 8))).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(project(rows, basis))
        basis = project_back(rows, q)
        basis, _ = np.linalg.qr(basis)
    small = project(rows, basis)
    _, _, v = np.linalg.svd(small, full_matrices=False)
    directions = (basis @ v[:rank].T).astype(np.float32)
    labels = np.array([x[4] for x in sample], dtype=np.float32)
    return Model(idf, directions, unit(project(rows, directions)), labels, float(labels.mean()))


def vote(model: Model, vectors: np.ndarray) -> np.ndarray:
    """Scores of documents by exact cosines with every labelled vector."""
    scores = np.empty(len(vectors))
    k = min(NEIGHBOURS, len(model.labels))
    for lo in range(0, len(vectors), BLOCK):
        cos = vectors[lo : lo + BLOCK] @ model.vectors.T
        # Equal cosines beyond the k-th vote as well, so that ties do not depend on an order.
        least = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k, None]
        weight = np.where(cos >= least, np.clip(cos, 0, 1), 0).astype(np.float64) ** POWER
        calm = 0.5**POWER
        scores[lo : lo + BLOCK] = (weight @ model.labels + calm * model.prior) / (weight.sum(axis=1) + calm)
    return np.clip(scores, 0, 1)


def sample_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled documents (text, label), those of least id hash.

    Twice as many labels are looked up, so labels without a document do not
    thin the sample; that table is bounded and goes to the documents, which
    stay where they are.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    picked = usable.withColumn("place", order).orderBy("place", "doc_id").limit(2 * most)
    met = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return met.groupBy("place", "doc_id", "label").agg(F.min("text").alias("text")).orderBy("place", "doc_id").limit(most).drop("place")


FIELDS = "terms array<int>, logs array<float>, form array<int>, weights array<float>"


def measured(df: DataFrame, keep=("doc_id",)) -> DataFrame:
    def make():
        rows = Rows()

        def work(texts):
            made = [(*rows.terms(t), *rows.form(t)) for t in texts]
            return list(zip(*made, strict=True))

        return work

    return map_texts(df, make, FIELDS, keep)


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the driver from the bounded sample; a row there has at most ``WIDTH`` entries."""
    found = measured(sample_rows(docs, labels), ["doc_id", "label"]).orderBy("doc_id").toArrow().to_pylist()
    arrays = lambda r: (np.array(r["terms"], np.int32), np.array(r["logs"], np.float32), np.array(r["form"], np.int32), np.array(r["weights"], np.float32))
    return fit([(*arrays(r), int(r["label"])) for r in found])


def score(df: DataFrame, model: Model | None, keep=("doc_id",)) -> DataFrame:
    """``keep``, ``score`` and ``predicted``."""
    held = df.sparkSession.sparkContext.broadcast(model and vars(model))

    def make():
        own = held.value and Model(**held.value)
        rows = Rows()

        def one(text) -> tuple[np.ndarray, np.ndarray]:
            at, logs = rows.terms(text)
            form, w = rows.form(text)
            return np.concatenate([at, form]), np.concatenate([weighted(own.idf, at, logs), w])

        def blocks(texts) -> Iterator[np.ndarray]:
            for lo in range(0, len(texts), 256):
                yield unit(project([one(t) for t in texts[lo : lo + 256]], own.directions))

        def work(texts):
            if own is None:
                return [[0.5] * len(texts), [1] * len(texts)]
            scores = vote(own, np.concatenate(list(blocks(texts))))
            return [scores, (scores >= 0.5).astype(np.int32)]

        return work

    return map_texts(df, make, "score double, predicted int", keep)
