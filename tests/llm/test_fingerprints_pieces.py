"""Fingerprints and word pieces against their definitions."""

import hashlib
import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace import Workspace
from millrace.llm import fingerprints, pieces, queries
from llm.conftest import prose

pytest.importorskip("public_tokenizers")


def similarity(a, b):
    a, b = (Counter((t or "").lower().split()) for t in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def chained(rows):
    """(doc_id, text, edited text) by descending id."""
    rows = sorted(rows, reverse=True)
    out = []
    for at, (i, t) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1] or ""
        t = t or ""
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + after[:half]))
    return out


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_edited_texts(spark, rows, space, parts):
    named = [(i, t) for i, t in rows if i is not None and i != 107]
    docs = spark.createDataFrame(named, "doc_id long, text string").repartition(3)
    got = fingerprints.edited(docs, space, parts=parts).collect()
    want = {i: (len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e in chained(named)}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want and len(got) == len(named)


def test_likeness(spark, space):
    named = [(i, prose(i // 2, 150 + i)) for i in range(60)]
    docs = spark.createDataFrame(named, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.edited(docs, space).collect()}
    texts = dict(named)
    off = [got[i].near_edited - similarity(t, e) for i, t, e in chained(named)]
    off += [got[i].near_next - similarity(texts[i], texts[(i - 1) % 60]) for i in texts]
    # Neighbours share words, hence draws, so errors do not average out fully.
    assert abs(sum(off) / len(off)) < 0.05 and math.sqrt(sum(x * x for x in off) / len(off)) < 0.1


def test_awkward_rows(spark, odd, none, rows):
    got = fingerprints.edited(odd, Workspace(spark)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r, t in [(r, t) for r in got for i, t in rows if i == r.doc_id and i not in (107, None)]:
        assert by_text.setdefault(t or "", r.fingerprint) == r.fingerprint
    empty = [r for r in got if r.doc_id in (100, 101, 102)]
    assert {r.fingerprint for r in empty} == {""}
    assert next(r for r in got if r.doc_id == 102).near_next == 1.0  # blank next to empty
    assert fingerprints.edited(none, Workspace(spark)).collect() == []
    one = fingerprints.edited(odd.where("doc_id = 3"), Workspace(spark)).collect()
    assert one[0].near_next == 1.0


def test_sample_probability(spark):
    """Collision rate over weighted sets, against generalised Jaccard."""
    one, two = "a a a b c c", "a b b c c d"
    docs = spark.createDataFrame([(0, one), (1, two)], "id long, text string")
    got = dict(fingerprints.fingerprints(docs, ["id"], "text", samples=64).collect())
    want = (1 + 1 + 2) / (3 + 2 + 2 + 1)
    assert abs(sum(x == y for x, y in zip(got[0], got[1], strict=True)) / 64 - want) < 0.2


# Pieces


def best(word, table, unknown, longest):
    """Viterbi over one word; ties go to the longer last piece."""
    scores, back = [0.0], [None]
    for stop in range(1, len(word) + 1):
        found = []
        for start in range(max(0, stop - longest), stop):
            piece = word[start:stop]
            if piece in table or len(piece) == 1:
                i, score = table.get(piece, (-1, unknown))
                found.append((scores[start] + score, -start, i))
        scores.append(max(found)[0])
        back.append(max(found))
    ids, at = [], len(word)
    while at:
        _, minus, i = back[at]
        ids = ([i] if i >= 0 else [3 + b for b in word[-minus:at].encode()]) + ids
        at = -minus
    return ids


def whole(text, table, unknown, longest):
    """Ids of a whole text as one lattice."""
    return best("▁" + text.replace(" ", "▁"), table, unknown, longest) if text else []


@pytest.fixture(scope="module")
def vocabulary(spark):
    frame, unknown, longest, first = pieces.piece_table(spark, queries.pieces_path())
    assert first == 3
    return {r.piece: (r.id, r.score) for r in frame.collect()}, unknown, longest


TEXTS = ["Hello world", "a  b", "   lead", "trail  ", "line\nnext\n\n  in", "中文 😀x", "▁mark", "tab\tend", "a" * 40, "the the the", "\n", " "]


def test_ids(spark, rows, space, vocabulary):
    texts = [(i, t) for i, t in rows if i is not None and len(t or "") < 3000 and i != 107] + list(enumerate(TEXTS, 1000))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in pieces.encode(docs, space, queries.pieces_path()).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        assert got[i] == whole(t or "", *vocabulary), t


def test_same_as_the_library(spark, vocabulary):
    """The library's own lattice over the same scores gives the same best path."""
    import sentencepiece

    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(queries.pieces_path(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    words = {w for i in range(8) for w in prose(i, 40).split()}
    got = pieces.encode_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), spark, queries.pieces_path()).collect()
    for r in got:
        assert list(r.ids) == library.nbest_encode_as_ids(r.word, 2)[0]


def test_long_words(spark, vocabulary):
    """Words around the bounds of names, parts and blocks, with letters of every width that are no piece."""
    texts, parts = [], ["the", "ing", "a", "xq", "é", "中", "\u07ff", "😀", "\x01", "zz", "internationalization"]
    for size in (63, 64, 65, 127, 128, 129, 255, 256, 257, 511, 512, 513, 1100, 3000):
        r = random.Random(size)
        word = "".join(r.choice(parts) for _ in range(size))[:size]
        texts += [word, f"{word} a {word[:-1]}", f"\n{word}", word]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (list(r.ids), r.round_trip) for r in pieces.encoded(docs, Workspace(spark), queries.pieces_path()).collect()}
    assert got == {i: (whole(t, *vocabulary), True) for i, t in enumerate(texts)}


def test_a_word_of_200000_letters(spark):
    r = random.Random(7)
    word = "".join(r.choice("etaoinshrdlu0123456789+/") for _ in range(200_000))
    start = time.time()
    row = pieces.digests(spark.createDataFrame([(1, word)], "doc_id long, text string"), Workspace(spark), queries.pieces_path()).first()
    assert row.round_trip and row.n_words == 1 and 50_000 < row.n_pieces <= 200_001
    assert time.time() - start < 100  # a fold that copies its state takes hours


def test_round_trip(spark, odd, none, rows):
    got = pieces.digests(odd, Workspace(spark), queries.pieces_path()).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[100].n_pieces, by_id[101].n_words) == (0, 0)
    ids = {r.doc_id: r.ids for r in pieces.encode(odd.where("doc_id IS NOT NULL"), Workspace(spark), queries.pieces_path()).collect()}
    assert all(len(ids[i]) == by_id[i].n_pieces for i in ids)
    assert pieces.digests(none, Workspace(spark), queries.pieces_path()).collect() == []


def test_hot_and_rare_words_agree(spark, space, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 5, 50)) for i in range(20)], "doc_id long, text string")
    want = sorted(map(tuple, pieces.digests(docs, space, queries.pieces_path()).collect()))
    monkeypatch.setattr(pieces, "HOT_CHARS", 4)
    assert sorted(map(tuple, pieces.digests(docs, space, queries.pieces_path()).collect())) == want


def test_texts_stay_where_they_are_read(spark, rows, monkeypatch):
    """No word and no text is shuffled, and a task that forgets its words gives the same rows."""
    docs = spark.createDataFrame([(i, t) for i, t in rows if len(t or "") < 3000], "doc_id long, text string")
    made = pieces.digests(docs, Workspace(spark), queries.pieces_path())
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    want = sorted(map(repr, made.collect()))
    monkeypatch.setattr(pieces, "LISTED_WORDS", 3)
    assert sorted(map(repr, pieces.digests(docs, Workspace(spark), queries.pieces_path()).collect())) == want


def test_digest_is_of_the_ids(spark, rows, vocabulary):
    """The query's numbers are those of each document's own ids, from first to last."""
    texts = [(i, t) for i, t in rows if i is not None and len(t or "") < 3000 and i != 107] + list(enumerate(TEXTS, 1000))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_pieces, r.ids_digest) for r in pieces.digests(docs, Workspace(spark), queries.pieces_path()).collect()}
    ids = spark.createDataFrame([(i, whole(t or "", *vocabulary)) for i, t in texts], "doc_id long, ids array<int>")
    assert got == {r[0]: (r[1], r[2]) for r in ids.selectExpr("doc_id", "size(ids)", "xxhash64(ids)").collect()}


def test_round_trip_sees_the_document(spark, monkeypatch):
    """Words that each decode well do not make a round trip where the document has another text."""
    docs = spark.createDataFrame([(0, "one two three"), (1, "one")], "doc_id long, text string")
    monkeypatch.setattr(pieces, "words", lambda text: text.split(" ")[:2])
    got = {r.doc_id: r.round_trip for r in pieces.digests(docs, Workspace(spark), queries.pieces_path()).collect()}
    assert got == {0: False, 1: True}


@pytest.mark.parametrize("counts", [range(1, 3000), range(1000, 5000), [10**9 + i * 10**7 for i in range(500)], [7000] * 400, [1] * 50])
def test_hot_words_are_bounded(spark, monkeypatch, counts):
    known = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate(counts)], "word string, n long").coalesce(1)
    monkeypatch.setattr(pieces, "HOT_WORDS", 300)
    got = sorted((r.n for r in pieces.hot_words(known).collect()), reverse=True)
    assert len(got) <= 300 and got == sorted(counts, reverse=True)[: len(got)]
    assert len(got) >= 290 or len(set(counts)) == 1  # close to the bound where counts differ


def drawn(spark, word):
    """The draws of a word from its hash, by number: r from one row of the table, ln c and b from another."""
    hashed = spark.sql("SELECT xxhash64(:w)", {"w": word}).first()[0] & (2**64 - 1)
    first, second = hashed >> 49, (hashed >> 34) & (fingerprints.TERMS - 1)
    table = {r.term: r for r in fingerprints.draws(spark).where(F.col("term").isin(first, second)).collect()}
    return hashed, table[first].r, table[second].lc, table[second].b


def test_samples_from_their_definition(spark):
    """Every sample of a weighted set recomputed: t, a and the word of the least a."""
    counts = {"ab": 1, "c": 2, "def": 7, "gh": 40, "été": 3}
    docs = spark.createDataFrame([(1, " ".join(w for w, n in counts.items() for _ in range(n)))], "id long, text string")
    got = fingerprints.fingerprints(docs, ["id"], "text").first().samples
    named = {w: drawn(spark, w) for w in counts}
    for k, sample in enumerate(got):
        found = []
        for word, n in counts.items():
            hashed, r, lc, b = named[word]
            t = math.floor(math.log(n) / r[k] + b[k])
            log_a = lc[k] - r[k] * (t - b[k]) - r[k]
            found.append((math.floor((log_a + 64) * 2**28), (hashed & (2**27 - 1)) ^ (t & 4095)))
        want = min(found)
        assert abs((sample >> 27) - want[0]) <= 1 and sample & (2**27 - 1) == want[1]


@pytest.mark.parametrize("size", [2_000, 20_000, 100_000])
def test_long_texts_share_only_what_they_share(spark, size):
    words = [f"w{i}" for i in range(2 * size)]
    texts = [(0, " ".join(words[:size])), (1, " ".join(words[size:])), (2, " ".join(words[size // 2 : size // 2 + size]))]
    got = {r.id: r.samples for r in fingerprints.fingerprints(spark.createDataFrame(texts, "id long, text string"), ["id"], "text").collect()}
    share = lambda a, b: sum(x == y for x, y in zip(got[a], got[b], strict=True)) / 64
    assert share(0, 1) < 0.02 and abs(share(0, 2) - 1 / 3) < 0.2 and abs(share(1, 2) - 1 / 3) < 0.2


def test_one_id_of_many_rows_is_many_buckets(spark, space):
    named = [(5, f"text number {i} of one id") for i in range(400)] + [(None, f"without {i}") for i in range(300)] + [(10 + i, f"other {i}") for i in range(300)]
    docs = spark.createDataFrame(named, "doc_id long, text string").repartition(4)
    ids = docs.select(F.col("doc_id").cast("double").alias("k"))
    cuts = sorted(ids.approxQuantile("k", [i / 16 for i in range(1, 16)], 0.25 / 16))
    dealt = docs.withColumn("bucket", fingerprints.bucket_of(F.col("doc_id"), cuts, F.xxhash64("text"), 1 + 16 * 300 // 1000))
    assert max(r["count"] for r in dealt.groupBy("bucket").count().collect()) < 200
    got = fingerprints.edited(docs, space, parts=8).collect()
    hashes = dict(docs.select("text", F.xxhash64("text")).collect())
    order = sorted(named, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = []
    for at, (i, t) in enumerate(order):
        after, half = order[(at + 1) % len(order)][1], len(t) // 2
        want.append((i, hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.edited_sha256)) for r in got)


def test_many_buckets_are_a_short_plan(spark):
    """The driver holds a few texts of numbers, not an expression for each cut."""
    cuts = [float(i // 3 * 3) for i in range(1687)]
    hashed = F.xxhash64("id")
    dealt = spark.range(3000).select("id", fingerprints.bucket_of(F.col("id"), cuts, hashed).alias("bucket"))
    assert len(dealt._jdf.queryExecution().analyzed().toJSON()) < 500_000
    got = dict(dealt.collect())
    for i, bucket in got.items():
        low, many = sum(c < i for c in cuts), max(1, cuts.count(i))
        assert 1 + low <= bucket < 1 + low + many


def test_texts_are_shuffled_once(spark, space):
    """Nothing is joined to the fingerprints, so nothing hangs on whether Spark sees that two shuffles are the same."""
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(50)], "doc_id long, text string")
    plan = fingerprints.edited(docs, space, parts=7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange hashpartitioning(bucket") == 1
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_rows_without_words_keep_their_places(spark, space, parts):
    """Likeness to the edited and the next text, where either may have no word, from each text's own samples."""
    texts = ["", None, " \n", prose(1, 20), "  " + prose(2, 25) + " ", prose(3, 8), "\t", "x", prose(1, 20)]
    named = [(i, texts[i % len(texts)]) for i in range(45)] + [(7, "x")] * 3 + [(None, ""), (None, prose(4, 12))]
    hashes = dict(spark.createDataFrame([(t or "",) for _, t in named], "t string").select("t", F.xxhash64("t")).collect())
    order = sorted(named, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1] or ""]))
    want = []
    for at, (i, t) in enumerate(order):
        t, after = t or "", order[(at + 1) % len(order)][1] or ""
        want.append((i, t, t[: len(t) - len(t) // 2] + after[: len(t) // 2], after))
    every = sorted({t for r in want for t in r[1:]})
    made = fingerprints.fingerprints(spark.createDataFrame(list(enumerate(every)), "i long, t string"), ["i"], "t").collect()
    assert len(made) == len(every)
    own = {every[r.i]: r.samples for r in made}
    assert {t for t in every if own[t] is None} == {t for t in every if not t.split()}

    def like(a, b):
        if own[a] is None or own[b] is None:
            return float(own[a] is own[b])
        return sum(x == y for x, y in zip(own[a], own[b], strict=True)) / len(own[a])

    got = fingerprints.edited(spark.createDataFrame(named, "doc_id long, text string").repartition(3), space, parts=parts).collect()
    seen = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint == "", r.edited_fingerprint == "", r.near_edited, r.near_next) for r in got]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(repr, seen)) == sorted(repr((i, len(t), digest(e), own[t] is None, own[e] is None, like(t, e), like(t, after))) for i, t, e, after in want)
