"""Small documents with the awkward cases every operator must define."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, row int, start string, key string"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    syllables = ["ta", "ri", "mon", "sel", "du", "ka", "pho", "el", "ra", "nin"]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) + r.choice(["", "", "", ".", ",", ".\n"]) for _ in range(words))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): nulls, empty and blank texts, a very long one, ties and repeated rows."""
    texts = [(i, prose(i % 17, 20 + 11 * i)) for i in range(30)]  # some share their beginning
    texts += [(100, None), (101, ""), (102, " \n\t "), (103, "\x00"), (104, "x" * 5000), (105, "é ß 中文 😀 ▁ İ")]
    texts += [(106, prose(99, 20_000)), (107, prose(3, 60)), (107, prose(3, 60)), (108, prose(3, 60)), (None, prose(5, 80)), (None, None)]
    return texts


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The rows as a table with columns whose names clash with results."""
    langs = ["en", "de", None]
    return spark.createDataFrame([(i, t, langs[n % 3], None, None, 0.5, "x", 7, "s", "k") for n, (i, t) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted(map(repr, rows))
