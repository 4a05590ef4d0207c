"""Harmonic packing of token ids into fixed-length sequences.

A document's ids (with an end id) are cut into pieces: whole sequences first,
then the rest. A rest of length r belongs to the reciprocal class
k = capacity // r, whose bins hold exactly k pieces. If r fills its share
capacity // k but for ``slack``, it stays whole; else a piece of the next
lower reciprocal length capacity // (k + 1) is cut off and the remainder goes
on the same way, so few cuts give bins that are nearly full.

Every task numbers the pieces of each class that it makes. Counts per task and
class, added up, turn these numbers into places in the whole class, and a
place divided by k is a bin: no worker waits for another, and at most one bin
per class is short. Those few short bins (their number is bounded by the
capacity) are joined first-fit.

Defined results: a null or empty text gives one piece with the end id alone;
repeated rows are packed one by one; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import _arrow_schema, chunks

CAPACITY = 2048
END_ID = 1
#: A piece may miss this share of its class's length and still stay whole.
SLACK = 0.02
#: Chunks of text whose ids a task remembers.
CACHE_CHUNKS = 500_000


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Chunks(dict):
    """Ids by chunk, made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.make(chunk)
        return ids


class Encoder:
    """Ids of whole texts by a ``tokenizers`` definition, chunk by chunk.

    Where the definition drops white space and never joins characters across
    it, the ids of a text are those of its chunks between spaces and line
    ends; ids of chunks are remembered up to a bound. A new chunk that is one
    lower-cased word of Latin letters, with punctuation after it or none, goes
    straight to the definition's merge model; all others go through the whole
    tokenizer. Both short cuts are taken only if they agree with the tokenizer
    on sample words; otherwise it gets whole texts or whole chunks.
    """

    TAIL = string.punctuation
    SAMPLE = ("a", "b.", "Cd's", "Élan,", "größer", "the.", "NIÑO", "x9", "rein", "Ündaïs.", "qwrtzp", "ababab,", "dogs'.", "a_###")

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known = Chunks(self._chunk)
        self.tails: dict[str, bytes] = {"": b""}
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        whole = self._whole(list(self.SAMPLE))
        self.by_chunk = all(self._whole([gap.join(self.SAMPLE)])[0] == b"".join(whole) for gap in (" ", "  ", "\n", " \n "))
        self.by_word = True
        self.by_word = all(self._word(c) in (None, ids) for c, ids in zip(self.SAMPLE, whole, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit bytes."""
        if not self.by_chunk:
            return self._whole(texts)
        split = [self._lower(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > CACHE_CHUNKS:
            self.known = Chunks(self._chunk)
        return [b"".join(map(self.known.__getitem__, s)) for s in split]

    def _lower(self, text: str) -> str:
        """Lower case where that is the tokenizer's own for certain: all of the text in Latin-1."""
        if not self.by_word:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def _chunk(self, chunk: str) -> bytes:
        ids = self._word(chunk) if chunk else b""
        return self._whole([chunk])[0] if ids is None else ids

    def _word(self, chunk: str) -> bytes | None:
        """Ids of a plain word, or None where only the whole tokenizer knows."""
        if not self.by_word:
            return None
        word = chunk.rstrip(self.TAIL)
        tail = chunk[len(word) :]
        if tail not in self.tails:
            if len(self.tails) > CACHE_CHUNKS:
                return None
            self.tails[tail] = self._whole([tail])[0]
        if word.isascii():
            if not word.isalpha():
                return None
            word = word.lower()
        else:
            if not word.isalpha() or max(word) >= "\u0180" or not unicodedata.is_normalized("NFC", word):
                return None
            word = word.lower()
            if not word.isalpha():
                return None
            word = "".join([self.letters[b] for b in word.encode()])
        return b"".join([self.bytes[t.id] for t in self.model.tokenize(word)]) + self.tails[tail]

    def _whole(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [b"".join([self.bytes[i] for i in e.ids]) for e in made]


def cuts(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Piece lengths of a document of ``length`` ids."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if rest >= (1 - slack) * (capacity // k):
            pieces.append(rest)
            break
        piece = capacity // (k + 1)
        pieces.append(piece)
        rest -= piece
    return pieces


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, worker int, class int, rank long"
#: Together they name a piece.
NUMBERS = ("worker", "class", "rank")


def pieces(df: DataFrame, definition: str, keep=("doc_id",), text: str = "text", with_ids: bool = False, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """One row per piece: ``keep``, its place in the document, and its rank in its class in its task."""
    fields = T.StructType.fromDDL(PIECES + (", ids binary" if with_ids else ""))
    keep = [c for c in keep if c not in fields.names]
    schema = T.StructType([df.schema[c] for c in keep] + fields.fields)
    arrow = _arrow_schema(schema)
    held = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(held.value)
        worker = TaskContext.get().partitionId()
        ranks: dict[int, int] = {}
        cut: dict[int, list[int]] = {}
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for part in chunks(texts):
                at, rows = [], []
                for i, ids in enumerate(own.encode(texts[part]), part.start):
                    ids += end
                    total = len(ids) // 4
                    if total not in cut:
                        if len(cut) > 100_000:
                            cut.clear()
                        cut[total] = cuts(total, capacity, slack)
                    start = 0
                    for length in cut[total]:
                        kind = capacity // length
                        rank = ranks.get(kind, 0)
                        ranks[kind] = rank + 1
                        body = ids[4 * start : 4 * (start + length)]
                        at.append(i)
                        rows.append((start, length, zlib.crc32(body), total, worker, kind, rank, body)[: len(fields)])
                        start += length
                index = pa.array(at, type=pa.int32())
                old = [batch.column(i).take(index).cast(arrow.field(i).type) for i in range(len(keep))]
                cols = [pa.array(c, type=arrow.field(len(keep) + i).type) for i, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(old + cols, schema=arrow)

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def bins(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``made`` (a written table of pieces) with ``sequence_id`` and ``offset``."""
    spark = made.sparkSession
    per_task = made.groupBy("class", "worker").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("class", "worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = made.join(offsets, ["class", "worker"]).withColumn("place", F.col("before") + F.col("rank"))
    placed = placed.withColumn("bin", F.floor(F.col("place") / F.col("class")))

    # One row per class: how many pieces, so where its bins start and which bin is short.
    totals = dict(per_task.groupBy("class").agg(F.sum("n")).collect())
    first, short, at = {}, [], 0
    for kind in sorted(totals):
        first[kind] = at
        at += totals[kind] // kind
        if totals[kind] % kind:
            short.append((kind, totals[kind] // kind, totals[kind] % kind))
    # A short bin is at most capacity // class tokens a piece; first fit by this bound, the largest first.
    rooms: list[list] = []
    target = {}
    for kind, index, count in sorted(short, key=lambda x: -x[2] * (capacity // x[0])):
        need = count * (capacity // kind)
        room = next((r for r in rooms if r[0] + need <= capacity), None)
        if room is None:
            room = [0, at + len(rooms)]
            rooms.append(room)
        target[kind] = (index, room[1])
        room[0] += need
    rows = [(k, first[k], *target.get(k, (None, None))) for k in sorted(totals)]
    bases = spark.createDataFrame(rows, "class int, first long, short long, joined long")
    placed = placed.join(F.broadcast(bases), "class")
    short_one = F.col("bin") == F.col("short")
    sequence = F.when(short_one, F.col("joined")).otherwise(F.col("first") + F.col("bin"))
    placed = placed.withColumn("sequence_id", sequence.cast("long"))
    before = Window.partitionBy("sequence_id").orderBy("class", "place").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return out.drop("place", "bin", "before", "first", "short", "joined")


def pack(df: DataFrame, definition: str, space, keep=("doc_id",), text: str = "text", with_ids: bool = False, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """Pieces with their sequence and offset. ``space`` holds the pieces between numbering and placing."""
    made = space.keep(pieces(df, definition, keep, text, with_ids, capacity, slack), "pieces")
    if not with_ids:
        return bins(made, capacity).drop(*NUMBERS)
    # Places are found without the ids, which then move once.
    return bins(made.drop("ids"), capacity).join(made.select(*NUMBERS, "ids"), list(NUMBERS)).drop(*NUMBERS)


def definition_of(path: str) -> str:
    """The tokenizer's definition, read on the driver and sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        return json.dumps(json.load(f))


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence of a packing ``with_ids``: its ids in order, and its padding.

    A sequence whose length is a power of two needs none.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    body = F.aggregate(F.transform(parts, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    used = F.col("used")
    padding = F.when(used.bitwiseAND(used - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - used)
    return packed.groupBy("sequence_id").agg(body.alias("ids"), F.sum("length").alias("used")).withColumn("padding", padding)


__all__ = ["pack", "pieces", "bins", "cuts", "sequences", "definition_of", "Encoder"]
