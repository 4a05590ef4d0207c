"""Language of each word by a linear-chain conditional random field.

A word's features are itself (the lexicon), its prefixes and suffixes of 1 to
3 letters and its letter 2- and 3-grams between edge marks, hashed into ``BUCKETS`` weight rows.
Labels are the languages of the training rows; transitions between words are
learned as well, on windows of training text that are spliced across
languages, as code-switched text is. Forward-backward gives every word its
label probabilities; the language of a text is the label with the largest
total, its score that total's share of the words.

Forward-backward runs on whole texts in segments of ``SEGMENT`` words: the
transfer matrix of each segment, then the chain over segments, then the words
inside them. All texts of a batch go through numpy together.

Training uses at most ``TRAIN_DOCS`` distinct texts, shared out evenly among the
languages; what a rare one leaves goes to the others. Within a language the
texts of least hash are taken. A longer text gives a window of ``TRAIN_CHARS``
characters at a place that its hash names. Of more than ``MOST_LANGUAGES``
values of the label column the most frequent are learned.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
repeated rows agree; of two equally likely languages the first by name wins; a
very long text is read whole, segment by segment; without any labelled row
every text is ``und``; an empty table gives an empty result; a kept column named
like a result gives way to it.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
TRAIN_DOCS = 1500
TRAIN_CHARS = 8_000
MOST_LANGUAGES = 200
HASHES = 2**40
WINDOW = 24
EPOCHS = 4
SEGMENT = 32
KNOWN_WORDS = 200_000
#: Grams of a longer word are those of its first and last halves of this length; its lexicon entry is the whole word.
LONG = 24


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # [BUCKETS + 1, labels]; the last row is zero, for padding
    start: np.ndarray
    transitions: np.ndarray  # [from, to]


def letters(word: str) -> bool:
    return any(map(str.isalpha, word))


def feature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weight rows of all words, one word after another, and how many each has.

    With the edge marks, the first and last grams are the affixes.
    """
    shown = [w if len(w) <= LONG else w[: LONG // 2] + w[-(LONG // 2) :] for w in words]
    points = np.frombuffer("".join([f"^{w}$" for w in shown]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in shown])
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(points)) - np.repeat(begin, sizes)
    left = np.repeat(sizes, sizes) - place  # letters from here to the word's end
    word = np.repeat(np.arange(len(words)), sizes)
    lexicon = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64) % np.uint64(BUCKETS)
    owners, rows = [np.arange(len(words))], [lexicon.astype(np.int32)]
    for k in (2, 3, 4):
        here = left >= k
        if k == 4:  # only as affixes
            here &= (place == 0) | (left == k)
        at = np.flatnonzero(here)
        total = np.full(len(at), k, dtype=np.uint64)
        for i in range(k):
            total = (total ^ points[at + i]) * np.uint64(0x100000001B3)
            total ^= total >> np.uint64(29)
        owners.append(word[at])
        rows.append((total % np.uint64(BUCKETS)).astype(np.int32))
    owner, row = np.concatenate(owners), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    return row[order], np.bincount(owner, minlength=len(words))


def padded(words: list[str]) -> np.ndarray:
    """Weight rows as a table, filled up with the zero row."""
    rows, counts = feature_rows(words)
    out = np.full((len(words), int(counts.max())), BUCKETS, dtype=np.int32)
    owner = np.repeat(np.arange(len(words)), counts)
    out[owner, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)] = rows
    return out


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """exp of each word's label scores, the largest 1."""
    out = np.empty((len(words), len(model.labels)))
    for at in range(0, len(words), 8192):
        rows, counts = feature_rows(words[at : at + 8192])
        score = np.add.reduceat(model.weights[rows], np.cumsum(counts) - counts, axis=0)
        out[at : at + 8192] = np.exp(score - score.max(axis=1, keepdims=True))
    return out


def posteriors(model: Model, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; ``e`` holds the texts' emissions one after another."""
    size = len(model.labels)
    step = np.exp(model.transitions)
    first = np.exp(model.start - model.start.max())
    lengths = lengths[lengths > 0]
    parts = -(-lengths // SEGMENT)
    total = int(parts.sum())
    text_of = np.repeat(np.arange(len(lengths)), parts)
    ordinal = np.arange(total) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(lengths) - lengths, parts) + ordinal * SEGMENT
    filled = np.minimum(SEGMENT, lengths[text_of] - ordinal * SEGMENT)
    at = begin[:, None] + np.arange(SEGMENT)
    valid = np.arange(SEGMENT) < filled[:, None]
    full = valid.all(axis=0)
    grid = np.where(valid[:, :, None], e[np.minimum(at, len(e) - 1)], 1.0)

    # Transfer matrix of each segment: entry (i, j) weighs label i before its first word and j on its last one.
    move = np.broadcast_to(np.eye(size), (total, size, size)).copy()
    for t in range(SEGMENT):
        ahead = (move.reshape(-1, size) @ step).reshape(move.shape) * grid[:, t, None, :]
        if t % 8 == 7:
            ahead /= ahead.max(axis=(1, 2), keepdims=True)
        move = ahead if full[t] else np.where(valid[:, t, None, None], ahead, move)

    # Chain over the segments of each text. Before the first word stands a label whose step gives the start weights.
    before = np.empty((total, size))
    head = np.cumsum(parts) - parts
    before[head] = np.linalg.lstsq(step.T, first, rcond=None)[0]
    after = np.ones((total, size))
    most = int(parts.max())
    for k in range(1, most):
        now = head[parts > k] + k
        v = np.einsum("ni,nij->nj", before[now - 1], move[now - 1])
        before[now] = v / np.abs(v).sum(axis=1, keepdims=True)
    for k in range(most - 2, -1, -1):
        now = head[parts > k + 1] + k
        v = np.einsum("nij,nj->ni", move[now + 1], after[now + 1])
        after[now] = v / v.sum(axis=1, keepdims=True)

    forward = np.empty((total, SEGMENT, size))
    state = before
    for t in range(SEGMENT):
        ahead = (state @ step) * grid[:, t]
        if t % 8 == 7:
            ahead /= ahead.max(axis=1, keepdims=True)
        state = ahead if full[t] else np.where(valid[:, t, None], ahead, state)
        forward[:, t] = state
    state = after
    for t in range(SEGMENT - 1, -1, -1):
        forward[:, t] *= state
        behind = (state * grid[:, t]) @ step.T
        if t % 8 == 7:
            behind /= behind.max(axis=1, keepdims=True)
        state = behind if full[t] else np.where(valid[:, t, None], behind, state)
    out = forward[valid]
    out /= out.sum(axis=1, keepdims=True)
    return out


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Conditional likelihood by Adam over windows of labelled words; ``rows`` are (text, language)."""
    labels = sorted({lang for _, lang in rows})
    known: dict[str, int] = {}
    runs = []
    for text, lang in rows:
        ids = [known.setdefault(w, len(known)) for w in words_of(text) if letters(w)]
        if ids:
            runs.append((np.array(ids), labels.index(lang)))
    if not runs:
        return None
    rng = np.random.default_rng(seed)
    size = len(labels)
    index = padded(list(known))
    weights = np.zeros((BUCKETS + 1, size))
    start, steps = np.zeros(size), np.eye(size)
    moments = [np.zeros_like(x) for x in (weights, weights, start, start, steps, steps)]
    windows, tags = [], []
    for ids, tag in runs:
        for at in range(0, max(1, len(ids) - WINDOW + 1), WINDOW):
            part = ids[at : at + WINDOW]
            windows.append(np.resize(part, WINDOW))
            tags.append(np.full(WINDOW, tag))
    windows, tags = np.array(windows), np.array(tags)
    # Code-switched windows: the end of one in four comes from another window.
    other = rng.permutation(len(windows))
    cut = np.where(rng.random(len(windows)) < 0.25, rng.integers(1, WINDOW, len(windows)), WINDOW)
    swap = np.arange(WINDOW) >= cut[:, None]
    windows, tags = np.where(swap, windows[other], windows), np.where(swap, tags[other], tags)
    batch, tick = 128, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            ids, y = windows[order[at : at + batch]], tags[order[at : at + batch]]
            n = len(ids)
            rows_of = index[ids]
            score = weights[rows_of].sum(axis=2)
            e = np.exp(score - score.max(axis=2, keepdims=True))
            move = np.exp(steps)
            f = np.empty((n, WINDOW, size))
            state = np.exp(start) * e[:, 0]
            f[:, 0] = state / state.sum(axis=1, keepdims=True)
            for t in range(1, WINDOW):
                state = (f[:, t - 1] @ move) * e[:, t]
                f[:, t] = state / state.sum(axis=1, keepdims=True)
            b = np.ones((n, WINDOW, size))
            pair = np.zeros((size, size))
            for t in range(WINDOW - 1, 0, -1):
                right = b[:, t] * e[:, t]
                joint = f[:, t - 1, :, None] * move * right[:, None, :]
                pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                state = right @ move.T
                b[:, t - 1] = state / state.sum(axis=1, keepdims=True)
            gamma = f * b
            gamma /= gamma.sum(axis=2, keepdims=True)
            true = np.eye(size)[y]
            slope = (true - gamma) / n
            grad = np.zeros_like(weights)
            flat = rows_of.reshape(-1)
            spread = np.repeat(slope.reshape(-1, size), index.shape[1], axis=0)
            for k in range(size):
                grad[:, k] = np.bincount(flat, weights=spread[:, k], minlength=BUCKETS + 1)
            grad[BUCKETS] = 0
            seen = np.zeros((size, size))
            np.add.at(seen, (y[:, :-1].reshape(-1), y[:, 1:].reshape(-1)), 1)
            tick += 1
            for i, (x, g) in enumerate(((weights, grad - 1e-4 * weights), (start, slope[:, 0].sum(axis=0)), (steps, (seen - pair) / n))):
                m, v = moments[2 * i], moments[2 * i + 1]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += 0.05 * (m / (1 - 0.9**tick)) / (np.sqrt(v / (1 - 0.99**tick)) + 1e-8)
            weights[BUCKETS] = 0
    return Model(labels, weights.astype(np.float32), start, steps)


def quotas(counts: dict[str, int], most: int) -> dict[str, int]:
    """Texts per language: even shares, and what a rare one leaves is shared among the rest."""
    given, left = {}, most
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        given[lang] = min(n, left // (len(counts) - i))
        left -= given[lang]
    return given


def training_rows(df: DataFrame, text: str = "text", lang: str = "lang", most: int = TRAIN_DOCS) -> list[tuple[str, str]]:
    """The documented sample: per language the distinct labelled texts of least hash, at most ``most`` in all.

    An approximate count of distinct texts per language sets the share of
    hashes that is looked at, so about a fifth more than ``most`` texts leave
    the tasks, however large the table and however many copies it holds.
    """
    usable = df.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    usable = usable.select(F.pmod(F.xxhash64(text), F.lit(HASHES)).alias("h"), F.col(text).alias("t"), F.col(lang).alias("l"))
    seen = usable.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES).collect()
    if not seen:
        return []
    # A count that is a little short must not cut a rare language.
    counts = {r.l: r.n for r in seen}
    wanted = quotas({name: math.ceil(1.1 * n) for name, n in counts.items()}, most)
    shares = {name: min(1.0, 1.25 * wanted[name] / counts[name]) for name in counts}
    limits = F.create_map(*[F.lit(x) for name, share in shares.items() for x in (name, int(share * HASHES))])
    place = F.lit(1) + F.pmod(F.col("h"), F.greatest(F.length("t") - TRAIN_CHARS + 1, F.lit(1)))
    window = F.substring(F.col("t"), place.cast("int"), F.lit(TRAIN_CHARS))
    picked = usable.where(F.col("h") < F.element_at(limits, F.col("l"))).select("h", "l", window.alias("t"))
    rows = picked.groupBy("h").agg(F.min("l").alias("l"), F.min("t").alias("t")).orderBy("h").collect()
    taken: dict[str, list[str]] = {}
    for r in rows:
        if len(taken.setdefault(r.l, [])) < wanted[r.l]:
            taken[r.l].append(r.t)
    return [(t, name) for name in sorted(taken) for t in taken[name]]


class Tagger:
    """Predictions for lists of texts; emissions of words are remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, len(model.labels)))

    def _learn(self, new: list[str]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
            self.rows = self.rows[:0]
        good = [w for w in new if letters(w)]
        base = len(self.rows)
        self.rows = np.concatenate([self.rows, emissions(self.model, good)])
        self.known.update(zip(good, range(base, base + len(good)), strict=True))
        self.known.update((w, -1) for w in new if not letters(w))

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word posteriors of all texts one after another, and the word count of each."""
        split = [words_of(t) for t in texts]
        new = {w for s in split for w in s if w not in self.known}
        if new:
            if len(self.known) + len(new) > KNOWN_WORDS:
                self.known.clear()
                self.rows = self.rows[:0]
                new = {w for s in split for w in s}
            self._learn(list(new))
        ids = np.array([i for s in split for i in map(self.known.__getitem__, s)], dtype=np.int64)
        owner = np.repeat(np.arange(len(split)), [len(s) for s in split])[ids >= 0]
        ids = ids[ids >= 0]
        lengths = np.bincount(owner, minlength=len(split))
        if not len(ids):
            return np.empty((0, len(self.model.labels))), lengths
        return posteriors(self.model, self.rows[ids], lengths), lengths

    def languages(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        p, lengths = self.posteriors(texts)
        owner = np.repeat(np.arange(len(texts)), lengths)
        sums = np.stack([np.bincount(owner, weights=p[:, k], minlength=len(texts)) for k in range(p.shape[1])], axis=1)
        best = sums.argmax(axis=1)
        share = sums[np.arange(len(texts)), best] / np.maximum(lengths, 1)
        labels = [self.model.labels[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)]
        return labels, [float(min(1.0, s)) if n else 0.0 for s, n in zip(share, lengths, strict=True)]


def predict(df: DataFrame, model: Model | None, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, ``lang_pred`` and ``score``."""
    held = df.sparkSession.sparkContext.broadcast(model and vars(model))

    def make():
        if held.value is None:  # nothing to learn from
            return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))
        return Tagger(Model(**held.value)).languages

    return map_texts(df, make, "lang_pred string, score double", keep, text)
