"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Characters of text that one call of a task's function gets; a longer text comes alone.
CHUNK_CHARS = 1_000_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def chunks(texts: Sequence[str], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Slices of ``texts`` that hold about ``most`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def spans(texts: pa.StringArray, most: int = CHUNK_CHARS) -> Iterator[slice]:
    """:func:`chunks` of texts that are not Python's yet, by their bytes."""
    return chunks([range(n) for n in pc.fill_null(pc.binary_length(texts), 0).to_pylist()], most)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list], Sequence]],
    fields: str,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    most: int = CHUNK_CHARS,
) -> DataFrame:
    """``keep`` and the columns that a function makes from the texts, row by row.

    ``make()`` runs once per task and returns ``f(texts) -> columns`` in the
    order of ``fields`` (a DDL string). Null texts arrive as None. A kept
    column with the name of a new one gives way to it. Batches are cut to
    ``most`` bytes before their texts become Python's, so memory follows the
    longest text, not the table.
    """
    new = T.StructType.fromDDL(fields)
    keep = [c for c in keep if c not in new.names]
    schema = T.StructType([df.schema[c] for c in keep] + new.fields)
    narrow = df.select(*keep) if text in keep else df.select(*keep, F.col(text).alias("__text"))
    place = keep.index(text) if text in keep else len(keep)
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in spans(batch.column(place), most):
                size = part.stop - part.start
                made = work(batch.column(place).slice(part.start, size).to_pylist())
                old = [batch.column(i).slice(part.start, size).cast(arrow.field(i).type) for i in range(len(keep))]
                cols = [pa.array(c, type=arrow.field(len(keep) + i).type) for i, c in enumerate(made)]
                yield pa.RecordBatch.from_arrays(old + cols, schema=arrow)

    return narrow.mapInArrow(run, schema)


def shielded(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under column names that no result has, and the new name of each column."""
    names = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def bared(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of :func:`shielded` under their own names."""
    return df.select(*[F.col(new).alias(old) for old, new in names.items()])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
