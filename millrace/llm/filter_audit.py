"""Filter interaction audit over a sparse document-term matrix.

Words of all documents get one global dictionary. Each task cuts its documents
into shards of bounded text. A shard has a dictionary of its own, in the order
of the words' hashes, and its documents are blocks of a compressed sparse row
(CSR) matrix over it. These small dictionaries are sliced by hash, each slice
travels as one packed row to the bucket of its hashes, where equal words of all
shards get one code, and the codes go back to their shards in the same order. A
row sum is a document's word count and the number of its nonzero entries is its
distinct words: they decide filters A and B. Flags C and D come from the text,
E from the least id of each text. A document is then one bit mask of failed
filters, counted per part, and the counts of all masks give every order and step
of the cascade.

Only the distinct words of a shard are shuffled, packed; the matrix moves once,
without its text. Buckets follow the number of shards, so a bucket's size does
not follow the corpus, and a word, however frequent, enters its bucket once per
shard. No row holds a whole shard: between tasks a shard is blocks of packed
entries, slices of packed words and slices of packed ranks, which meet as a
sorted stream, so a task holds the codes of the shard at hand and one block. No
key grows with copies of a text: they are counted per text and id before the
text alone is a key.

Defined results: a null text is an empty one (no words: fails A, and B does not
apply to 0 words); an empty or null ``lang`` is the part named by the empty
string; repeated rows count one by one, and a row is a copy (E) only of a text
under a smaller id, so rows with one id are not copies of each other, and a row
without an id is never one; of several labels of a document each that says 1
counts; a very long text is a shard alone; an empty table has no part and gives
no row. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import json
import math
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The filters of the contract.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
MOST_COUNT = 32_767
#: Characters of text in a shard; a longer text is a shard alone.
SHARD_CHARS = 8_000_000
#: Characters of text in a block of a shard; a longer text is a block alone.
BLOCK_CHARS = 500_000
#: What a document weighs besides its text, so that empty ones fill blocks as well.
DOCUMENT_CHARS = 100
#: The least number of buckets of the global dictionary, as a power of two; there are at least twice as many as shards.
BUCKET_BITS = 8
#: Slices of words in a batch.
SLICES = 1024
#: Bytes of a row group of the written shards, which readers decode as a whole.
GROUP_BYTES = 8_000_000

#: Rows of two kinds: blocks of documents, numbered within their shard, and pieces of its dictionary (``place`` is null).
PARTS = (
    "shard long, place int, doc_ids array<long>, langs array<string>, texts array<binary>, upper array<boolean>, symbol array<boolean>, "
    "starts array<int>, columns binary, counts binary, words binary"
)


def arrow_schema(fields: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(fields))


def lists(values, field: pa.Field) -> pa.Array:
    """``values`` as the only list of a column."""
    flat = values if isinstance(values, pa.Array) else pa.array(values, type=field.type.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], type=pa.int32()), flat).cast(field.type)


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all low bytes first, compressed."""
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind: type) -> np.ndarray:
    """``count`` numbers that :func:`packed` made."""
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, count * size, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(size, count).T).reshape(-1).view(kind)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def by_hash(dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words by hash, and their hashes in that order."""
    hashes = np.concatenate([np.empty(0, np.uint64), *(word_hashes(dictionary.slice(i, 8192).to_pylist()) for i in range(0, len(dictionary), 8192))])
    order = np.argsort(hashes, kind="stable")
    return order, hashes[order]


def sparse_rows(place: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CSR arrays (starts, columns, counts) of texts whose words stand at ``place`` in a dictionary, one text after another.

    A count over 32,767 is several entries.
    """
    cells = np.repeat(np.arange(len(lengths)) * width, lengths) + place
    cells, counts = np.unique(cells, return_counts=True)
    parts = -(-counts // MOST_COUNT)
    if (parts > 1).any():
        first = np.cumsum(parts) - parts
        cells, rest = np.repeat(cells, parts), counts - (parts - 1) * MOST_COUNT
        counts = np.full(len(cells), MOST_COUNT)
        counts[first] = rest
    starts = np.searchsorted(cells, np.arange(len(lengths) + 1) * width)
    return starts.astype(np.int32), (cells % width).astype(np.int32), counts.astype(np.int16)


def flags(texts: list[bytes]) -> list[list]:
    """Digest, flag C and flag D of each text."""
    # Code points are bytes that do not continue one.
    points = [len(t) - len(t.translate(None, bytes(range(0x80)) + bytes(range(0xC0, 0x100)))) for t in texts]
    upper = [100 * (len(t) - len(t.translate(None, UPPER))) > MOST_UPPER_PERCENT * n for t, n in zip(texts, points, strict=True)]
    symbol = [len(t.translate(None, SYMBOLS)) < len(t) for t in texts]
    return [[hashlib.md5(t, usedforsecurity=False).digest() for t in texts], upper, symbol]


def shards(docs: DataFrame, chars: int = SHARD_CHARS) -> DataFrame:
    """The shards' blocks, documents with their flags and matrix, and the pieces of their dictionaries.

    A shard is numbered by task and place, so the result has to be written
    before it is read twice. ``texts`` are digests. A piece holds the words
    whose hashes share their first ``BUCKET_BITS`` bits, by hash, with spaces
    between, which no word has.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")), F.coalesce("text", F.lit("")).cast("binary"))
    arrow = arrow_schema(PARTS)

    def block(number, place, told, starts, columns, counts):
        made = [pa.array([number]), pa.array([place], type=pa.int32())]
        made += [lists(x, f) for x, f in zip([*told, starts], list(arrow)[2:8], strict=True)]
        made += [pa.array([packed(x)], type=pa.binary()) for x in (columns, counts)]
        return pa.RecordBatch.from_arrays([*made, pa.nulls(1, pa.binary())], schema=arrow)

    def pieces(number, words, hashes):
        cuts = np.append(np.unique(hashes >> np.uint64(64 - BUCKET_BITS), return_index=True)[1], len(words))
        joined = [b" ".join(words.slice(a, b - a).to_pylist()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        empty = [pa.nulls(len(joined), f.type) for f in list(arrow)[1:-1]]
        return pa.RecordBatch.from_arrays([pa.array([number] * len(joined)), *empty, pa.array(joined, type=pa.binary())], schema=arrow)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        ready: list[tuple] = []
        size = held = 0  # weight of the shard, and of what is not yet in a block

        def cut():
            nonlocal waiting, held
            ids, langs, texts = zip(*waiting, strict=True)
            split = [t.split() for t in texts]
            lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
            ready.append(([ids, langs, *flags(texts)], lengths, pa.array([w for words in split for w in words], type=pa.binary())))
            waiting, held = [], 0

        def made():
            nonlocal number, ready, size
            cut()
            coded = pa.chunked_array([words for _, _, words in ready], type=pa.binary()).dictionary_encode()
            dictionary = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], type=pa.binary())
            order, hashes = by_hash(dictionary)
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            # Chunks without words are left out of the result.
            spots = np.concatenate([np.empty(0, np.int32), *(c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks)])
            begun, blocks = 0, [(told, lengths) for told, lengths, _ in ready]
            ready, size = [], 0
            for i, (told, lengths) in enumerate(blocks):
                end = begun + int(lengths.sum())
                yield block(number, i, told, *sparse_rows(place[spots[begun:end]], lengths, max(1, len(order))))
                begun = end
            if len(order):
                yield pieces(number, dictionary.take(pa.array(order)), hashes)
            number += 1

        for batch in batches:
            ids, langs, texts = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                weight = len(text) + DOCUMENT_CHARS
                if waiting and size + weight > chars:
                    yield from made()
                elif waiting and held + weight > BLOCK_CHARS:
                    cut()
                waiting.append((ids[i].as_py(), langs[i].as_py(), text))
                size, held = size + weight, held + weight
        if waiting:
            yield from made()

    return narrow.mapInArrow(run, PARTS)


SLICE = "shard long, bucket int, words binary"


def slices(parts: DataFrame, bits: int) -> DataFrame:
    """The dictionaries of all shards, cut at the top ``bits`` of the words' hashes."""
    arrow = arrow_schema(SLICE)

    def run(batches):
        made: list[tuple] = []

        def out():
            cols = [pa.array(c, type=f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(cols, schema=arrow)

        for batch in batches:
            for r in range(batch.num_rows):
                shard, words = batch.column(0)[r].as_py(), batch.column(1)[r].as_py().split(b" ")
                buckets, firsts = np.unique(word_hashes(words) >> np.uint64(64 - bits), return_index=True)
                ends = [*firsts[1:].tolist(), len(words)]
                made += [(shard, k, b" ".join(words[a:b])) for k, a, b in zip(buckets.tolist(), firsts.tolist(), ends, strict=True)]
                if len(made) >= SLICES:
                    yield out()
        if made:
            yield out()

    return parts.where("words IS NOT NULL").select("shard", "words").mapInArrow(run, SLICE)


def ranked(table: pa.Table) -> pa.Table:
    """The slices of one bucket with the rank of each word among the bucket's distinct words, four bytes each."""
    split = pc.split_pattern(table.column("words").combine_chunks(), pattern=" ")
    words = split.flatten()
    distinct = pc.unique(words)
    distinct = distinct.take(pc.sort_indices(distinct))
    ends = np.append(0, 4 * np.cumsum(pc.list_value_length(split).to_numpy())).astype(np.int32)
    ranks = pc.index_in(words, distinct).to_numpy().astype("<i4")
    blobs = pa.Array.from_buffers(pa.binary(), len(split), [None, pa.py_buffer(ends), pa.py_buffer(ranks)])
    return pa.table({"shard": table.column("shard"), "bucket": table.column("bucket"), "ranks": blobs})


RANKED = "shard long, bucket int, ranks binary"


def dictionary_ranks(parts: DataFrame) -> DataFrame:
    """(shard, bucket, ranks): the words of each shard's own dictionary, in its order, by their rank in a bucket.

    The global code of a word is the bucket of its hash and, in the low 32
    bits, its rank there: unique in the corpus, the same in every shard and
    every run.
    """
    bits = max(BUCKET_BITS, parts.where("place = 0").count().bit_length() + 1)
    return slices(parts, bits).groupBy("bucket").applyInArrow(ranked, RANKED)


MATRIX = (
    "shard long, doc_ids array<long>, langs array<string>, texts array<binary>, upper array<boolean>, symbol array<boolean>, "
    "starts array<int>, columns array<int>, counts array<short>, codes array<long>"
)


def matrix(docs: DataFrame, space, chars: int = SHARD_CHARS) -> DataFrame:
    """Blocks of the document-term matrix under global column codes, a few for each shard.

    Columns: ``shard, doc_ids, langs, texts, upper, symbol, starts, columns,
    counts, codes``; entry ``k`` of row ``i`` (``starts[i] <= k < starts[i+1]``)
    says that word ``codes[columns[k]]`` occurs ``counts[k]`` times.
    """
    parts = space.keep(shards(docs, chars), "shards", **{"parquet.block.size": GROUP_BYTES})
    blocks = parts.where("place IS NOT NULL").drop("words")
    ranks = dictionary_ranks(parts).withColumnRenamed("bucket", "place")
    # Of each shard first the ranks, in the order of its dictionary, then the blocks.
    both = ranks.withColumn("kind", F.lit(0)).unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    stream = both.repartition("shard").sortWithinPartitions("shard", "kind", "place")
    told = ["doc_ids", "langs", "texts", "upper", "symbol", "starts"]
    arrow = arrow_schema(MATRIX)

    def run(batches):
        at, pieces, codes = None, [], None
        for batch in batches:
            shard, kind, place, ranks = (batch.column(i).to_numpy(zero_copy_only=False) if i < 3 else batch.column(i) for i in range(4))
            turns = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *turns], [*turns, len(shard)], strict=True):
                if shard[a] != at:
                    at, pieces, codes = shard[a], [], None
                if kind[a] == 0:
                    counts = pc.binary_length(ranks.slice(a, b - a)).to_numpy() // 4
                    values = np.frombuffer(b"".join(ranks.slice(a, b - a).to_pylist()), dtype="<i4")
                    pieces.append((np.repeat(place[a:b].astype(np.int64) << 32, counts)) + values)
                    continue
                if codes is None:
                    codes, pieces = np.concatenate([np.empty(0, np.int64), *pieces]), []
                for r in range(a, b):
                    kept = [batch.column(4 + i).slice(r, 1) for i in range(len(told))]
                    entries = kept[-1].flatten()[-1].as_py()
                    columns, counts = (unpacked(batch.column(4 + len(told) + i)[r].as_py(), entries, t) for i, t in enumerate((np.int32, np.int16)))
                    used = np.zeros(len(codes), dtype=bool)
                    used[columns] = True
                    own = np.cumsum(used, dtype=np.int32) - 1  # the words of the block alone
                    last = [lists(x, f) for x, f in zip((own[columns], counts, codes[used]), list(arrow)[-3:], strict=True)]
                    cols = [pa.array([at]), *kept, *last]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return stream.select("shard", "kind", "place", "ranks", *told, "columns", "counts").mapInArrow(run, MATRIX)


def document_rows(blocks: DataFrame) -> DataFrame:
    """Per document of :func:`matrix`: its flags, the sum of its row and the number of its nonzero columns."""
    own = lambda c: f"slice({c}, starts[i] + 1, starts[i + 1] - starts[i])"
    each = lambda made: F.expr(f"transform(sequence(0, size(doc_ids) - 1), i -> {made})")
    n_words = each(f"aggregate({own('counts')}, 0L, (total, n) -> total + n)")
    # Entries of one word can be several.
    n_distinct = each(f"CAST(size(array_distinct(transform({own('columns')}, c -> codes[c]))) AS LONG)")
    zipped = F.arrays_zip("doc_ids", "langs", "texts", "upper", "symbol", n_words.alias("n_words"), n_distinct.alias("n_distinct"))
    return blocks.select(F.inline(zipped).alias("doc_id", "lang", "text", "upper", "symbol", "n_words", "n_distinct"))


def masks(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters (bit i: filter i) and labels."""
    yes = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    fails = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words"),
        F.col("upper"),
        F.col("symbol"),
    ]
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))
    docs = rows.select("doc_id", "text", F.col("lang").alias("part"), bits.alias("mask")).join(yes, "doc_id", "left")
    kind = ["text", "part", "mask", "good", "toxic"]
    docs = docs.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    by_id = docs.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    # Rows with the least id of their kind, and all rows; so a text's copies become a few rows before the text is a key.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    by_text = by_id.groupBy(*kind).agg(
        first.alias("first"), F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("text"))
    own = F.col("no_id") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    told = by_text.select("part", "good", "toxic", "mask", "n", own.alias("own"))
    both = F.array(F.struct(F.col("mask"), F.col("own").alias("n")), F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("own")).alias("n")))
    split = told.select("part", "good", "toxic", F.explode(both).alias("m")).select("part", "good", "toxic", "m.mask", "m.n")
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def steps() -> Column:
    """All steps of all orders: filter_order, step, the step's filter and those before it as bits."""
    made = []
    for order in permutations(FILTERS):
        before = 0
        for i, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            made.append({"filter_order": "".join(order), "step": i + 1, "bit": bit, "before": before})
            before |= bit
    return F.from_json(F.lit(json.dumps(made)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")


def audit(counts: DataFrame) -> DataFrame:
    """Every part, order and step from :func:`masks`, zeros included."""
    spread = counts.select("part", "mask", "good", "toxic", "n", F.explode(steps()).alias("s")).select("part", "mask", "good", "toxic", "n", "s.*")
    mask = F.col("mask")
    fails = mask.bitwiseAND(F.col("bit")) != 0
    earlier = mask.bitwiseAND(F.col("before")) != 0
    removed = fails & ~earlier
    orders = math.factorial(len(FILTERS))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    # Of the filters that a document fails each comes first in an equal share of all orders.
    share = F.when(fails, F.col("n") * F.expr(f"{orders} DIV greatest(bit_count(mask), 1)"))
    return spread.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(mask == F.col("bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        F.coalesce(F.sum(share), F.lit(0)).cast("long").alias("shapley"),
    )
