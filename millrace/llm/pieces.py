"""SentencePiece encoding and decoding in tasks.

Text is cut at its spaces; each run of spaces opens a word that begins with as
many marks U+2581, and a text begins with one. No piece holds the mark after
another letter, so words encode on their own; a line end, which no piece
holds, opens a word as well.

Each word is a lattice: its substrings of up to the longest piece's length are
looked up in a trie of the pieces (broadcast; its size is the vocabulary's), and a
substring that begins no piece ends the search from its first letter. Edges go
from the first position to the last: a position holds the best score so far and
the edge it came by; ties go to the longer last piece. A walk back gives the
path. A letter that is no piece is an edge below all others, written as the byte
pieces of its UTF-8 form. A position takes 16 bytes, and the work grows with the
word's length.

A text stays where it is read: its task encodes the words that it has not met
yet, puts the ids of all words in order, decodes the ids alone and compares what
comes out with the document. Nothing is shuffled, so disk and network do not
grow with the words. Words are remembered up to ``LISTED_WORDS`` words and
``LONG_CHARS`` characters, then from anew.

:func:`lexicon` has the ids and the counts of all distinct words as a table.

Defined results: a null or empty text has no words and no pieces; U+2581 in a
text is taken as a space; repeated rows are encoded one by one; scores are
those of the model file, used as unigram scores whatever its kind; an empty
table gives no rows; very long texts and words are encoded whole; of other
columns than key and text none is read.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import _arrow_schema, chunks

MARK = "▁"
RUN = re.compile("  +")
UNKNOWN_PENALTY = 10.0
HOT_WORDS = 200_000
#: Words that a task lists before it hands them on, or remembers with their ids.
LISTED_WORDS = 250_000
#: Tasks of the lexicon for each shuffle partition.
SPREAD = 8
#: A hot word is at most this long, so the broadcast table is bounded in bytes too.
HOT_CHARS = 64
#: A word of more characters goes by a hash.
LONG = 64
#: Characters of long words that a task holds before it hands them on, or of all words that it remembers.
LONG_CHARS = 16_000_000


def piece_table(spark: SparkSession, path: str) -> tuple[DataFrame, float, int, int]:
    """Pieces (piece, id, score) of a model file, the score of an unknown letter, the longest piece, the id of byte 0."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i)
    rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in range(model.get_piece_size()) if not special(i)]
    if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece, _, _ in rows):
        raise ValueError("pieces with a line end, or a mark after another letter, do not split into words")
    first_byte = next((i for i in range(model.get_piece_size()) if model.is_byte(i)), -1)
    least = min(score for _, _, score in rows)
    return spark.createDataFrame(rows, "piece string, id int, score double"), least - UNKNOWN_PENALTY, max(len(r[0]) for r in rows), first_byte


def words(text: str | None) -> list[str]:
    """The words of a text, without the first mark of each; one that begins with a line end has none."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " ":
        text = RUN.sub(lambda m: " " + MARK * (len(m.group()) - 1), " " + text)[1:]
    return text.replace("\n", " \n").split(" ")


def names(text: str | None) -> list[str]:
    """The words of a text, long ones by a hash; no word begins with two line ends."""
    return [w if len(w) <= LONG else "\n\n" + hashlib.sha256(w.encode("utf-8", "surrogatepass")).hexdigest() for w in words(text)]


def marked(word: str) -> str:
    return word if word.startswith("\n") else MARK + word


def lattice(pieces: list[tuple[str, int, float]], unknown: float, first_byte: int) -> Callable[[str], bytes]:
    """The function that gives the ids of a word's best path, as int32 in bytes."""
    # A trie: what follows, and the score and id if the letters so far are a piece.
    root: dict[str, list] = {}
    for piece, i, score in pieces:
        here, node = root, None
        for letter in piece:
            node = here.setdefault(letter, [{}, None, -1])
            here = node[0]
        node[1:] = score, i
    longest = max(len(piece) for piece, _, _ in pieces)

    def ids(word: str) -> bytes:
        s = marked(word)
        n = len(s)
        if n <= LONG:
            scores, starts, came = [-math.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        else:  # 16 bytes a position
            scores, starts, came = array("d", [-math.inf]) * (n + 1), array("i", [0]) * (n + 1), array("i", [0]) * (n + 1)
        scores[0] = 0.0
        for start in range(n):
            score, here, stop = scores[start], root, start
            for letter in s[start : start + longest]:
                node = here.get(letter)
                if node is None:
                    break
                here, own, i = node
                stop += 1
                # Starts come in rising order, so an equal score keeps the longer last piece.
                if own is not None and score + own > scores[stop]:
                    scores[stop], starts[stop], came[stop] = score + own, start, i
            node = root.get(s[start])
            if (node is None or node[1] is None) and score + unknown > scores[start + 1]:
                scores[start + 1], starts[start + 1], came[start + 1] = score + unknown, start, -1 - ord(s[start])
        path = array("i")
        at = n
        while at:
            if came[at] >= 0:
                path.append(came[at])
            else:
                path.extend(first_byte + b for b in reversed(chr(-1 - came[at]).encode()))
            at = starts[at]
        path.reverse()
        return path.tobytes()

    return ids


def lattice_of(spark: SparkSession, path: str):
    """A broadcast of what :func:`lattice` needs of a model file."""
    table, unknown, _, first_byte = piece_table(spark, path)
    return spark.sparkContext.broadcast(([tuple(r) for r in table.collect()], unknown, first_byte))


def encode_words(distinct: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """(word, n, ids): the pieces of each distinct word of ``distinct`` (word, n; a ``body``, if any, is what a word stands for)."""
    held = lattice_of(spark, path)
    body = F.coalesce("body", "word") if "body" in distinct.columns else F.col("word")
    schema = T.StructType([distinct.schema["word"], distinct.schema["n"], *T.StructType.fromDDL("ids array<int>").fields])
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = lattice(*held.value)
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            for part in chunks(bodies):
                size = part.stop - part.start
                old = [batch.column(i).slice(part.start, size).cast(arrow.field(i).type) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*old, unpacked([ids(w) for w in bodies[part]]).cast(arrow.field(2).type)], schema=arrow)

    return distinct.select("word", "n", body.alias("body")).mapInArrow(run, schema)


def piece_bytes(path: str) -> list[bytes]:
    """The bytes that each id stands for."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    each = [(model.id_to_piece(i), model.is_byte(i)) for i in range(model.get_piece_size())]
    return [bytes([int(piece[3:5], 16)]) if is_byte else piece.encode() for piece, is_byte in each]


def text_of(ids: list[int], table: list[bytes]) -> str:
    """The text that ids stand for, a space for each mark."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``, the text of each array of ids (null for null), a space for each mark."""
    schema = T.StructType([f for f in encoded.schema.fields if f.name != out] + [T.StructField(out, T.StringType())])
    arrow = _arrow_schema(schema)
    held = encoded.sparkSession.sparkContext.broadcast(piece_bytes(path))
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            arrays = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            text = [None if a is None else text_of(a, table) for a in arrays]
            old = [batch.column(batch.schema.get_field_index(c)).cast(arrow.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays([*old, pa.array(text, pa.string())], schema=arrow)

    return encoded.mapInArrow(run, schema)


def distinct_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, body, n): every distinct word and how often it occurs, in many small partitions by word.

    ``word`` is the word as :func:`names` has it, ``body`` a long word itself, else null.
    """
    schema = T.StructType.fromDDL("word string, body string, n long")
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        bodies: dict[str, str] = {}
        held = 0

        def out():
            found = list(seen.items())
            seen.clear()
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                columns = [pa.array([w for w, _ in part], pa.string()), pa.array([bodies.get(w) for w, _ in part], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in part], pa.int64())], schema=arrow)
            bodies.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                called = names(t)
                seen.update(called)
                for name, word in zip(called, words(t) if any(len(w) > LONG for w in called) else (), strict=False):
                    if len(name) > LONG and name not in bodies:
                        bodies[name] = word
                        held += len(word)
                if len(seen) > LISTED_WORDS or held > LONG_CHARS:
                    yield from out()
                    held = 0
        yield from out()

    parts = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = docs.select(text).mapInArrow(run, schema)
    return listed.repartition(parts, "word").groupBy("word", "body").agg(F.sum("n").alias("n"))


def hot_bound(counted: DataFrame, most: int = HOT_WORDS) -> int:
    """The least count that at most ``most`` words reach; above all counts where the top one has more.

    From one row per count up to 1,023 and per 512th of a power of two beyond,
    so the driver gets some thousands of rows however large the counts are.
    """
    rounded = F.expr("n - n % shiftleft(1L, greatest(0, length(bin(n)) - 10))")
    per_count = counted.groupBy(rounded.alias("c")).agg(F.count("*").alias("words")).orderBy(F.desc("c")).collect()
    total, bound = 0, 2**63 - 1
    for row in per_count:
        total += row["words"]
        if total > most:
            break
        bound = row["c"]
    return bound


def lexicon(docs: DataFrame, space, path: str, text: str = "text") -> DataFrame:
    """(word, n, ids) of all distinct words of ``docs``, as a written table."""
    return space.keep(encode_words(distinct_words(docs, text), docs.sparkSession, path), "lexicon")


def hot_words(known: DataFrame) -> DataFrame:
    """The most frequent words of a lexicon, ``HOT_WORDS`` at most, each of bounded length."""
    return known.where((F.col("n") >= hot_bound(known, HOT_WORDS)) & (F.length("word") <= HOT_CHARS))


def unpacked(lists: list[bytes]) -> pa.ListArray:
    """An array of ids from each list's bytes."""
    ends = np.cumsum([0] + [len(raw) // 4 for raw in lists]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(lists), np.int32)))


class Encoder:
    """Ids of texts; the ids of words are remembered up to a bound."""

    def __init__(self, ids: Callable[[str], bytes]):
        self.word_ids = ids
        self.known: dict[str, bytes] = {}
        self.held = 0

    def ids(self, text: str) -> tuple[int, bytes]:
        """How many words a text has, and its ids as int32 in bytes."""
        if len(self.known) > LISTED_WORDS or self.held > LONG_CHARS:
            self.known.clear()
            self.held = 0
        known = self.known
        split = words(text)
        for word in set(split).difference(known):
            known[word] = self.word_ids(word)
            self.held += len(word)
        return len(split), b"".join(map(known.__getitem__, split))


def encoded(docs: DataFrame, space, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_words``, ``ids`` and ``round_trip`` (the ids decode to the text)."""
    spark = docs.sparkSession
    held = lattice_of(spark, path)
    bytes_held = spark.sparkContext.broadcast(piece_bytes(path))
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    schema = T.StructType([rows.schema["__id"], *T.StructType.fromDDL("n_words long, ids array<int>, round_trip boolean").fields])
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = Encoder(lattice(*held.value)), bytes_held.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in chunks(texts):
                counts, joined, same = [], [], []
                for t in texts[part]:
                    n, raw = encoder.ids(t)
                    counts.append(n)
                    joined.append(raw)
                    shown = " " + t.replace(MARK, " ") if t else ""  # a text begins with a mark
                    same.append(text_of(np.frombuffer(raw, np.int32).tolist(), table) == shown)
                old = batch.column(0).slice(part.start, part.stop - part.start).cast(arrow.field(0).type)
                yield pa.RecordBatch.from_arrays([old, pa.array(counts, pa.int64()), unpacked(joined).cast(arrow.field(2).type), pa.array(same)], schema=arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("__id", key)


def encode(docs: DataFrame, space, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and ``ids``, the pieces of its text in order (empty without words)."""
    return encoded(docs, space, path, key, text).select(key, "ids")


def digests(docs: DataFrame, space, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of :func:`encoded`: ``key``, ``n_words``, ``n_pieces``, ``ids_digest`` (xxhash64 of its ids) and ``round_trip``."""
    facts = [F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest")]
    return encoded(docs, space, path, key, text).select(key, "n_words", *facts, "round_trip")
