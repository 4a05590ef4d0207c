"""Sharding and packing: their laws, recomputed from the results."""

import zlib
from collections import Counter, defaultdict
from hashlib import md5
from math import log

import numpy as np
import pytest

from millrace import Workspace
from millrace.llm import packing, queries, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")


def place(key, weights):
    """The shard by the definition."""
    text = "" if key is None else str(key)
    scores = [-w / log((int(md5(f"{text}/{name}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48) for name, w in weights.items()]
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


@pytest.mark.parametrize("weights, grown", [(sharding.even(24), sharding.even(25)), ({"a": 1.0, "b": 3.0, "c": 0.5}, {"a": 1.0, "b": 3.0, "c": 0.5, "d": 2.0})])
def test_shards(odd, rows, space, weights, grown):
    got = sharding.shard(odd, weights, grown, space).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == place(r.doc_id, weights) and r.grown_shard == place(r.doc_id, grown)
        assert r.grown_shard in (r.shard, len(weights))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == texts


def test_weights_are_met(spark):
    weights = {"a": 1.0, "b": 3.0}
    counts = dict(spark.range(8000).select(sharding.choose(sharding.F.col("id"), weights).alias("s")).groupBy("s").count().collect())
    assert abs(counts[1] / 8000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.choose(sharding.F.col("id"), {"a": 0.0})


def test_no_shards_of_nothing(none, space):
    assert sharding.shard(none, sharding.even(3), sharding.even(4), space).collect() == []


@pytest.fixture(scope="module")
def definition():
    return packing.definition_of(queries.tokenizer_path())


def ids_by_tokenizer(definition, texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(definition).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, packing.END_ID], dtype="<u4") for e in made]


def test_cuts():
    for length in [*range(1, 2100), 4096, 100_003]:
        made = packing.cuts(length)
        assert sum(made) == length and min(made) > 0 and max(made) <= 2048
        assert all(n * (2048 // n) >= 0.97 * 2048 for n in made) and len(made) <= 8 + length // 2048


def check_packing(packed, by_id):
    """``by_id``: ids of each document id, all rows of one id being equal."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, ids in by_id.items():
        copies = sum(r.start == 0 for r in pieces[key])
        assert Counter(i for r in pieces[key] for i in range(r.start, r.start + r.length)) == Counter(dict.fromkeys(range(len(ids)), copies))
        for r in pieces[key]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sequences


def test_packing(odd, rows, space, definition):
    kept = [(i, t) for i, t in rows if i is not None]
    by_id = dict(zip([i for i, _ in kept], ids_by_tokenizer(definition, [t for _, t in kept]), strict=True))
    packed = packing.pack(odd.where("doc_id IS NOT NULL"), definition, space).collect()
    sequences = check_packing(packed, by_id)
    total = sum(len(by_id[i]) for i, _ in kept)
    assert len(sequences) <= total / 2048 * 1.02 + 12


def test_sequences(odd, space, definition):
    packed = packing.pack(odd, definition, space, with_ids=True)
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * r.used and r.padding == (0 if r.used & (r.used - 1) == 0 else 2048 - r.used)


def test_nothing_to_pack(none, space, definition):
    assert packing.pack(none, definition, space).collect() == []


def test_ids_are_the_tokenizers(definition):
    import random

    r = random.Random(5)
    letters = "abcDEéÉßİΣσς'sſKffiǅªº.,;!?0129½²Ⅳ \n\t\r\x0b\x85\xa0　​\x1c\x00é̈中文ñÑ<|endoftext|>😀"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(4000)]
    texts += ["a<|endoftext|>b <|startoftext|> x", "don't we'll 'S I'M dogs'.", "", " ", "\n"]
    encoder = packing.Encoder(definition)
    assert encoder.by_chunk and encoder.by_word
    want = [i[:-1].tobytes() for i in ids_by_tokenizer(definition, texts)]
    assert encoder.encode(texts) == want


def test_other_tokenizers_get_whole_texts():
    encoder = packing.Encoder(packing.definition_of(public_tokenizers.path("byte_bpe_50k.json")))
    assert not encoder.by_chunk
    text = "Some  words,\nand more"
    assert len(encoder.encode([text])[0]) == 4 * len(encoder.tokenizer.encode(text).ids)
