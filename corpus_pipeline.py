"""Corpus pipeline: quality rules, language, near-duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language_crf, near_dups, packing, quality_rules, secrets
from millrace.llm.common import bared, read, shielded
from millrace.llm.queries import tokenizer_path
from millrace.session import Workspace

#: Tokenization and fitted models cannot be stated in SQL; tests hold each stage against brute force.
ORACLE_SQL = None
#: A text in which no language reaches this share of the words has none; code-switched texts of two languages stay.
LEAST_SHARE = 0.4


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the cascade of quality rules keeps."""
    return quality_rules.kept_documents(docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing ``lang`` gets the predicted one.

    The model learns from all labelled documents and judges every text. Texts
    without a letter go, and so do texts without a given ``lang`` in which no
    language has ``LEAST_SHARE`` of the words. A given ``lang`` is kept
    whatever the share, and where no document has one every text is unknown,
    which says nothing of the texts: all documents stay.
    """
    model = language_crf.train(language_crf.training_rows(docs))
    plain, names = shielded(docs)
    seen = language_crf.predict(plain, model, plain.columns, names["text"])
    known = F.col("lang_pred") != language_crf.UNKNOWN
    sure = F.col(names["lang"]).isNotNull() | (F.col("score") >= LEAST_SHARE)
    kept = seen.where(F.lit(model is None) | (known & sure))
    return bared(kept.withColumn(names["lang"], F.coalesce(names["lang"], F.when(known, F.col("lang_pred")))), names)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_dups.survivors(docs, Workspace(spark), threshold=0.8)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret replaced by the name of its kind."""
    return secrets.redact(docs, Workspace(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in a sequence."""
    return packing.pack(docs, packing.definition_of(tokenizer_path()), Workspace(spark), with_ids=True)


STAGES = [
    ("quality rules", rules),
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each),
    ("secret scan", no_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents, each written and read again."""
    space = Workspace(spark)
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = space.keep(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
