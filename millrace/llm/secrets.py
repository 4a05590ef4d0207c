"""Secret scans: base patterns and a battery of randomness tests.

Base patterns find assignments, access keys and long hex runs. Other long
tokens are tested for randomness over the alphabet of their inferred encoding:
chi-squared uniformity, runs above and below the middle of the alphabet, and
lag-one serial correlation, joined by Fisher's method into one p-value of
"drawn at random". Random tokens have even p-values, ordinary ones p-values
near 0. So for each encoding and length class the corpus-wide histogram of the
p-values of distinct tokens tells how many ordinary ones lie above a threshold
(all above it, less the random ones that the even upper part predicts); copies
of a token say nothing new and count once. The lowest threshold whose false
share is within ``rate`` is used for that class, so short tokens, where the
tests are weak, meet a stricter one. A class that is known to hold ordinary
tokens counts a part of one more as false, which guards small classes. A class
of so few distinct tokens that all of them could lie in the lower half by
chance cannot tell on its own: there a token is random if at most a share of
``rate`` of the ordinary ones in the other classes of its length or shorter
reaches its p-value and the tests do not reject it at the level ``rate``.

Defined results: a null text is an empty one, with no spans and the hash of an
empty string; repeated rows are scanned one by one.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bared, map_texts, shielded

KINDS = ("assign", "access", "hex", "random")
# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # a shorter run cannot hold a longer one, so the length may stand in the pattern
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: ``=`` belongs to a token as its last padding only, so the value of ``name=value`` is a token of its own.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
#: Encodings from narrow to wide: the first whose alphabet holds a token is its own.
ALPHABETS = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
BINS = 100
#: A threshold below this bin would flag what the tests reject outright.
LEAST_BIN, MIDDLE_BIN = 1, 50
FALSE_RATE = 0.05

_ORDERS = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}
_SETS = {name: frozenset(letters) for name, letters in ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def tail(chi: float, degrees: int) -> float:
    """Upper tail of the chi-squared distribution (Wilson-Hilferty; exact for an even 2 and 4 and 6)."""
    if degrees % 2 == 0 and degrees <= 60:
        half, term, total = chi / 2, 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= half / i
            total += term
        return min(1.0, math.exp(-half) * total)
    z = ((chi / degrees) ** (1 / 3) - (1 - 2 / (9 * degrees))) / math.sqrt(2 / (9 * degrees))
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: str) -> str:
    letters = set(token)
    return next(name for name, known in _SETS.items() if letters <= known)


def randomness(token: str) -> tuple[str, float]:
    """Encoding and the p-value of "each symbol drawn evenly and on its own"."""
    token = token.rstrip("=")
    name = encoding(token)
    order, size, n = _ORDERS[name], len(ALPHABETS[name]), len(token)
    x = np.fromiter((order[c] for c in token), dtype=np.float64, count=n)
    bins = int(max(4, min(size, n // 4)))
    counts = np.bincount((x * bins // size).astype(np.int64), minlength=bins)
    width = np.bincount(np.arange(size) * bins // size, minlength=bins) / size
    even = tail(float(((counts - n * width) ** 2 / (n * width)).sum()), bins - 1)
    above = x >= size / 2
    high = int(above.sum())
    low = n - high
    if not high or not low:
        runs = 0.0
    else:
        mean = 1 + 2 * high * low / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        gap = max(0.0, abs(1 + int((above[1:] != above[:-1]).sum()) - mean) - 0.5)
        runs = math.erfc(gap / math.sqrt(2 * spread)) if spread > 0 else 0.0
    d = x - (size - 1) / 2
    lag = float((d[1:] * d[:-1]).sum()) / ((size * size - 1) / 12 * math.sqrt(n - 1))
    serial = math.erfc(abs(lag) / math.sqrt(2))
    return name, tail(-2 * sum(math.log(max(p, 1e-300)) for p in (even, runs, serial)), 6)


def length_class(n: int) -> int:
    """0 for under 24, then one class per half octave."""
    return 0 if n < 24 else 1 + int(2 * math.log2(n / 24))


def token_hash(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.rstrip("=").encode(), digest_size=8).digest(), "big", signed=True)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """(start, end, class, p bin, hash) of long tokens that touch no base span."""
    found = []
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, _, e in taken):
            continue
        name, p = randomness(m.group())
        found.append((start, end, f"{name}/{length_class(end - start)}", min(BINS - 1, int(p * BINS)), token_hash(m.group())))
    return found


SCAN = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start:long,kind:int,end:long>>, tokens array<struct<start:long,end:long,class:string,bin:int,hash:long>>"
)


def scan(df: DataFrame, keep=("doc_id",), text: str = "text") -> DataFrame:
    """Per row: base counts and spans, and tested tokens."""

    def make():
        def work(texts):
            cols: list[list] = [[] for _ in range(6)]
            for text in texts:
                text = text or ""
                spans = base_spans(text)
                kinds = [k for _, k, _ in spans]
                joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                row = (
                    *(kinds.count(k) for k in range(3)),
                    hashlib.sha256(joined.encode()).hexdigest(),
                    [{"start": s, "kind": k, "end": e} for s, k, e in spans],
                    [{"start": s, "end": e, "class": c, "bin": b, "hash": h} for s, e, c, b, h in candidates(text, spans)],
                )
                for col, value in zip(cols, row, strict=True):
                    col.append(value)
            return cols

        return work

    return map_texts(df, make, SCAN, keep, text)


def ordinary_tail(per_bin: np.ndarray) -> np.ndarray:
    """How many ordinary tokens lie in each bin or above."""
    above = per_bin[::-1].cumsum()[::-1]
    even = above[MIDDLE_BIN] / (BINS - MIDDLE_BIN)  # random tokens per bin
    return above - even * np.arange(BINS, 0, -1)


def own_threshold(per_bin: np.ndarray, rate: float) -> int:
    """The lowest bin from which on at most a share of ``rate`` of the class's tokens is ordinary."""
    above, false = per_bin[::-1].cumsum()[::-1], ordinary_tail(per_bin)
    false = false + max(0.0, false[0]) / above[0]  # the pseudo-count for small classes
    return next((b for b in range(LEAST_BIN, BINS) if above[b] and false[b] <= rate * above[b]), BINS)


def lent_threshold(others: np.ndarray, rate: float) -> int:
    """The lowest bin, from a p-value of ``rate`` on, that at most a share of ``rate`` of other classes' ordinary tokens reaches."""
    tail, least = ordinary_tail(others), max(LEAST_BIN, round(rate * BINS))
    return next((b for b in range(least, BINS) if tail[b] <= rate * max(0.0, tail[0])), BINS) if tail[0] > 0 else least


def thresholds(scanned: DataFrame, rate: float = FALSE_RATE) -> dict[str, int]:
    """Per class the lowest p bin that counts as random, from all distinct tokens of the corpus.

    Copies of a token go before the shuffle, within a task. The driver gets one
    row per class and bin: encodings x length classes x ``BINS``, however large
    the corpus.
    """
    tokens = scanned.select(F.explode("tokens").alias("t")).select("t.class", "t.bin", "t.hash").distinct()
    seen = tokens.groupBy("class", "bin").count().collect()
    counts: dict[str, np.ndarray] = {}
    for name, at, n in seen:
        counts.setdefault(name, np.zeros(BINS))[at] = n
    length = lambda name: int(name.rpartition("/")[2])
    large = {name: per_bin for name, per_bin in counts.items() if 0.5 ** per_bin.sum() <= rate}
    chosen = {}
    for name, per_bin in counts.items():
        if name in large:
            chosen[name] = own_threshold(per_bin, rate)
        else:
            others = [other for key, other in large.items() if length(key) <= length(name)]
            chosen[name] = lent_threshold(np.sum(others, axis=0) if others else np.zeros(BINS), rate)
    return chosen


def with_spans(scanned: DataFrame, chosen: dict[str, int]) -> DataFrame:
    """``scanned`` with ``found``: all spans by start, then kind."""
    limits = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair]) if chosen else None
    base = F.col("base")
    if limits is not None:
        random = F.transform(
            F.filter("tokens", lambda t: t["bin"] >= F.element_at(limits, t["class"])),
            lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
        )
        base = F.array_sort(F.concat(base, random))
    return scanned.withColumn("found", base)


def spans_text(spans) -> F.Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def find(df: DataFrame, space, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, base counts, ``base_sha256``, ``found`` spans. ``space`` holds the scan between the two passes."""
    scanned = space.keep(scan(df, keep, text), "scan")
    return with_spans(scanned, thresholds(scanned)).drop("base", "tokens")


def redact(df: DataFrame, space, text: str = "text") -> DataFrame:
    """``df`` with every span replaced by ``[kind]``; overlapping spans become one, named by the first.

    Rows without spans stay as they are; ``n_chars`` follows a changed text if
    it is there. Texts are scanned twice, once for the thresholds, so that none
    is written in between.
    """
    tokens = space.keep(scan(df, [], text).select("tokens").where(F.size("tokens") > 0), "tokens")
    plain, names = shielded(df)
    body = names[text]
    marked = with_spans(scan(plain, plain.columns, body), thresholds(tokens))
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        gap = F.substring(F.col(body), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], gap, kinds[span["kind"]])).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    rest = lambda s: F.concat(s["out"], F.substring(F.col(body), (s["at"] + 1).cast("int"), F.length(body)))
    out = marked.withColumn(body, F.when(F.size("found") == 0, F.col(body)).otherwise(F.aggregate("found", start, step, rest)))
    if "n_chars" in names:
        count = names["n_chars"]
        out = out.withColumn(count, F.when(F.size("found") > 0, F.length(body).cast("long")).otherwise(F.col(count)))
    return bared(out, names)
