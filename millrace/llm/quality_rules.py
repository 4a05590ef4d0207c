"""Quality rules as a short-circuit cascade.

Each document is measured once (``base_counts``); then rules run one after
another until one rejects it. A small sample tells the share of documents a
rule rejects and its cost in CPU time; rules run by rejections per cost, the
highest first. The order changes the cost, never the verdict: a document is
kept if no rule rejects it.

Defined results: a null or empty text has no words and fails the base; repeated
rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_texts

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
#: Documents in the sample that orders the rules.
SAMPLE_ROWS = 1000


class Text:
    """A text with the parts that rules ask for, each made at most once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode("utf-8", "surrogatepass")
        self.words = self.data.split()

    def part(self, name: str, make: Callable):
        found = self.__dict__.get(name)
        if found is None:
            found = self.__dict__[name] = make(self)
        return found

    @property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return self.part("_lines", lambda t: [x for x in t.data.split(b"\n") if x.strip()])

    @property
    def word_chars(self) -> int:
        return self.part("_chars", lambda t: len(t.text) - len(t.data) + len(t.data.translate(None, SPACE)))

    @property
    def symbols(self) -> int:
        return self.part("_symbols", lambda t: len(t.data) - len(t.data.translate(None, SYMBOLS)))

    @property
    def dup_lines(self) -> int:
        return self.part("_dups", lambda t: len(t.lines) - len(set(t.lines)))

    @property
    def repeat_words(self) -> int:
        return self.part("_repeats", lambda t: repeated_words(t.words))

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < LEAST_WORDS or 100 * self.repeat_words > MOST_REPEAT_PERCENT * n


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words which occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + width - max(i, end)
            end = i + width
    return covered


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a test of a :class:`Text`; ``sql`` states it over the columns of the check."""

    name: str
    rejects: Callable[[Text], bool]
    sql: str


def mean_length(t: Text) -> bool:
    n = len(t.words)
    return t.word_chars < 2 * n or t.word_chars > 20 * n


def symbol_share(t: Text) -> bool:
    return 100 * t.symbols > 7 * t.word_chars


def line_repeats(t: Text) -> bool:
    return t.dup_lines > 2 and 100 * t.dup_lines > 30 * len(t.lines)


def few_distinct(t: Text) -> bool:
    return 100 * len(set(t.words)) < 5 * min(len(t.words), 2000)


def bullet_lines(t: Text) -> bool:
    return 100 * sum(x.lstrip().startswith((b"-", b"*", "•".encode())) for x in t.lines) > 90 * len(t.lines)


def cut_lines(t: Text) -> bool:
    return 100 * sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > 30 * len(t.lines)


RULES = (
    Rule("mean_length", mean_length, "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbol_share", symbol_share, "100 * n_symbols > 7 * word_chars"),
    Rule("line_repeats", line_repeats, "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("few_distinct", few_distinct, "100 * n_distinct < 5 * least(n_words, 2000)"),
    Rule("bullet_lines", bullet_lines, "100 * n_bullets > 90 * n_lines"),
    Rule("cut_lines", cut_lines, "100 * n_cut > 30 * n_lines"),
)


def rejected(t: Text, rules) -> str | None:
    """The first rule that rejects, or None."""
    return next((rule.name for rule in rules if rule.rejects(t)), None)


def trial(df: DataFrame, rules=RULES, text: str = "text") -> dict[str, tuple[int, int, int]]:
    """Per rule: documents tried, documents rejected, nanoseconds, each rule on its own copy of the text."""
    rules = tuple(rules)

    def make():
        def work(texts):
            tried = []
            for text in texts:
                row = []
                for rule in rules:
                    t = Text(text)
                    start = time.thread_time_ns()
                    no = rule.rejects(t)
                    row.append((int(no), time.thread_time_ns() - start))
                tried.append(row)
            return [[[x[0] for x in row] for row in tried], [[x[1] for x in row] for row in tried]]

        return work

    seen = map_texts(df, make, "no array<int>, cost array<long>", keep=(), text=text)
    sums = [x for i in range(len(rules)) for x in (F.sum(F.col("no")[i]), F.sum(F.col("cost")[i]))]
    total, *found = seen.agg(F.count("*"), *sums).first()
    return {r.name: (total, found[2 * i] or 0, found[2 * i + 1] or 0) for i, r in enumerate(rules)}


def sample(df: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """About ``rows`` documents, picked by a hash of their text."""
    step = max(1, df.count() // rows)
    return df.where(F.pmod(F.xxhash64(F.col(text)), F.lit(step)) == 0)


def cascade(df: DataFrame, rules=RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> tuple[Rule, ...]:
    """Rules by rejections per cost on a sample; ties keep the given order."""
    rules = tuple(rules)
    seen = trial(sample(df, rows, text), rules, text)
    return tuple(sorted(rules, key=lambda r: -(seen[r.name][1] / max(1, seen[r.name][2]))))


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def judge(df: DataFrame, order, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, the base counts and the verdict of the cascade ``order``."""
    order = tuple(order)

    def make():
        def work(texts):
            rows = []
            for text in texts:
                t = Text(text)
                failed = t.base_failed
                kept = not failed and rejected(t, order) is None
                rows.append((len(t.words), t.word_chars, t.symbols, t.dup_lines, t.repeat_words, failed, kept))
            return list(zip(*rows, strict=True))

        return work

    return map_texts(df, make, COUNTS, keep, text)


def kept_documents(df: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` that base and cascade keep, with all their columns."""
    order = cascade(df, rules, text=text)

    def make():
        def work(texts):
            docs = map(Text, texts)
            return [[not t.base_failed and rejected(t, order) is None for t in docs]]

        return work

    return map_texts(df, make, "__kept boolean", df.columns, text).where("__kept").select(*df.columns)
