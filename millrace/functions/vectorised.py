"""Text functions that Spark has no built-in form of, over Arrow batches.

Each is an iterator function: what it needs is made once per task, then batches
of a column pass through. They are made by a call so that Spark ships them with
their code. Where a built-in form exists, jobs use that one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F


def strip_accents():
    """``f(text)``: letters without their accents; what has no plain form stays. Null stays null."""

    @F.pandas_udf("string")
    def stripped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata

        class Table(dict):
            """Letters without marks, by code point, filled as characters are met."""

            def __missing__(self, point):
                parts = unicodedata.normalize("NFD", chr(point))
                self[point] = "".join(c for c in parts if unicodedata.category(c) != "Mn")
                return self[point]

        table = Table()
        for texts in batches:
            yield texts.map(lambda t: t if t is None or t.isascii() else t.translate(table))

    return stripped


def name_similarity():
    """``f(a, b)``: Jaro-Winkler similarity of two texts in [0, 1]; null if one is null.

    Matches lie within half the longer text; a common start of up to four
    characters raises a similarity above 0.7. Pairs met before in a task are
    looked up, as names repeat.
    """

    @F.pandas_udf("double")
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        from functools import lru_cache

        @lru_cache(maxsize=100_000)
        def jaro_winkler(a: str, b: str) -> float:
            if not a and not b:
                return 1.0
            reach = max(0, max(len(a), len(b)) // 2 - 1)
            places: dict[str, list[int]] = {}
            for j, c in enumerate(b):
                places.setdefault(c, []).append(j)
            used, matched, order = set(), [], []
            for i, c in enumerate(a):
                j = next((j for j in places.get(c, ()) if abs(i - j) <= reach and j not in used), None)
                if j is not None:
                    used.add(j)
                    matched.append(c)
                    order.append(j)
            m = len(matched)
            if not m:
                return 0.0
            moved = sum(c != b[j] for c, j in zip(matched, sorted(order), strict=True)) // 2
            jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
            prefix = next((i for i in range(min(4, len(a), len(b))) if a[i] != b[i]), min(4, len(a), len(b)))
            return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro

        for left, right in batches:
            yield pd.Series([None if a is None or b is None else jaro_winkler(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")

    return similarity
