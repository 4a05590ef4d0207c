"""Quality and language: held-out accuracy on generated texts; inference against plain recursions."""

import random

import numpy as np

from millrace.llm import language_crf, quality_knn
from llm.conftest import prose

SOUNDS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "eit", "zu"], "cc": ["ción", "ñe", "lla", "os"]}


def speech(lang, seed, words=40):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SOUNDS[lang]) for _ in range(r.randint(1, 3))).capitalize() + r.choice(["", ",", "!"]) for _ in range(words))


def test_languages(spark, odd, none, rows):
    model = language_crf.train([(speech(lang, i), lang) for lang in SOUNDS for i in range(30)])
    texts = [(i, speech(lang, 100 + i), lang) for i in range(20) for lang in SOUNDS]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = language_crf.predict(docs, model, ["doc_id", "lang"]).collect()
    assert len(got) == 60 and all(r.lang_pred == r.lang and 0.9 < r.score <= 1 for r in got)
    awkward = language_crf.predict(odd, model).collect()
    by_id = {r.doc_id: r for r in awkward}
    assert len(awkward) == len(rows)
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (100, 101, 102, 103))
    assert by_id[105].lang_pred != "und"
    assert language_crf.predict(none, model).collect() == []
    assert language_crf.training_rows(none) == [] and language_crf.train([]) is None
    assert {r.lang_pred for r in language_crf.predict(odd, None).collect()} == {"und"}


def test_code_switching_is_seen_word_by_word():
    model = language_crf.train([(speech(lang, i), lang) for lang in SOUNDS for i in range(30)])
    tagger = language_crf.Tagger(model)
    p, lengths = tagger.posteriors([speech("aa", 500, 30) + " " + speech("cc", 501, 25)])
    said = [model.labels[k] for k in p.argmax(axis=1)]
    assert lengths.tolist() == [55] and said == ["aa"] * 30 + ["cc"] * 25


def test_posteriors_match_plain_forward_backward():
    r = np.random.default_rng(1)
    model = language_crf.Model(["a", "b", "c"], None, r.normal(size=3), r.normal(size=(3, 3)))
    lengths = np.array([1, 31, 32, 33, 0, 200, 2])
    e = np.exp(r.normal(size=(lengths.sum(), 3)) * 3)
    e /= e.max(axis=1, keepdims=True)
    got, at, step = language_crf.posteriors(model, e, lengths), 0, np.exp(model.transitions)
    for n in lengths:
        x = e[at : at + n]
        f, b = np.ones((n, 3)), np.ones((n, 3))
        for t in range(n):
            f[t] = (np.exp(model.start) if t == 0 else f[t - 1] @ step) * x[t]
            f[t] /= f[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = step @ (b[t + 1] * x[t + 1])
            b[t] /= b[t].sum()
        want = f * b / (f * b).sum(axis=1, keepdims=True)
        assert np.allclose(got[at : at + n], want, atol=1e-9)
        at += n


def test_features_hold_affixes_and_lexicon():
    flat, counts = language_crf.feature_rows(["aß", "x" * 100, "aß"])
    assert counts[0] == counts[2] and (flat[: counts[0]] == flat[-counts[2] :]).all()
    # lexicon; ^a aß ß$; ^aß aß$; ^aß$ once for both ends
    assert counts[0] == 1 + 3 + 2 + 1


def labelled(spark, n):
    good = [(i, prose(i, 80 + i % 50), 1) for i in range(n)]
    bad = [(n + i, " ".join(w + "###" for w in prose(i, 60 + i % 50).split()), 0) for i in range(n // 2)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad], "doc_id long, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in good + bad}


def test_quality(spark, odd, none, rows):
    docs, labels, truth = labelled(spark, 120)
    model = quality_knn.train(docs, labels.where("doc_id % 3 <> 1"))
    assert model.vectors.shape[0] == sum(i % 3 != 1 for i in truth)
    got = {r.doc_id: r for r in quality_knn.score(docs, model).collect()}
    held = [i for i in truth if i % 3 == 1]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    awkward = quality_knn.score(odd, model).collect()
    assert len(awkward) == len(rows) and all(0 <= r.score <= 1 for r in awkward)
    assert quality_knn.score(none, model).collect() == []
    nothing = quality_knn.train(docs, labels.where("doc_id < 0"))
    assert nothing is None and {r.score for r in quality_knn.score(odd, nothing).collect()} == {0.5}


def test_labels_with_nulls_repeats_and_strangers(spark):
    docs, _, _ = labelled(spark, 6)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (777, 1), (2, 1)], "doc_id long, quality int")
    rows = quality_knn.sample_rows(docs.unionByName(docs), labels).collect()
    assert {(r.doc_id, r.label) for r in rows} == {(0, 0), (2, 1)} and len(rows) == 2


def test_votes_match_brute_force():
    r = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    vectors, asked = unit(r.normal(size=(90, 8))).astype(np.float32), unit(r.normal(size=(2500, 8))).astype(np.float32)
    model = quality_knn.Model(None, None, vectors, r.integers(0, 2, 90).astype(np.float32), 0.4)
    got = quality_knn.vote(model, asked)
    for i in range(0, 2500, 97):
        cos = sorted(((float(a @ asked[i]), float(label)) for a, label in zip(vectors, model.labels, strict=True)), reverse=True)[: quality_knn.NEIGHBOURS]
        weights = [max(0.0, c) ** quality_knn.POWER for c, _ in cos]
        calm = 0.5**quality_knn.POWER
        assert abs(got[i] - (sum(w * q for w, (_, q) in zip(weights, cos, strict=True)) + calm * 0.4) / (sum(weights) + calm)) < 1e-4


def syllables(seed, words, parts):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(words))


DE, FR = ["sch", "ung", "ein", "ver", "keit"], ["eau", "oui", "que", "ée", "ais"]


def test_rare_languages_are_learned(spark):
    """Two in 4,000 texts, next to thousands of others and a third of copies: all of them are in the sample."""
    rows = [(i, syllables(i, 12, DE), "de") for i in range(4000)] + [(9000 + i, "ein ver ung", "de") for i in range(2000)]
    rows += [(20_000 + i, syllables(i, 12, FR), "fr") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    sample = language_crf.training_rows(docs)
    langs = [lang for _, lang in sample]
    assert langs.count("fr") == 2 and 1300 <= langs.count("de") <= 1500 and len(set(sample)) == len(sample)
    model = language_crf.train(sample)
    new = spark.createDataFrame([(1, syllables(99, 30, FR)), (2, syllables(98, 30, DE))], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_crf.predict(new, model).collect()} == {1: "fr", 2: "de"}


def test_only_long_texts_are_learned_by_windows(spark):
    rows = [(i, syllables(i, 9000, DE if i % 2 else FR), "de" if i % 2 else "fr") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_crf.training_rows(docs)
    assert len(sample) == 6 and all(len(t) == language_crf.TRAIN_CHARS and any(t in text for _, text, _ in rows) for t, _ in sample)
    got = language_crf.predict(docs, language_crf.train(sample)).collect()
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "fr") for r in got)


def test_quotas():
    assert language_crf.quotas({"a": 5, "b": 10_000, "c": 10_000}, 1500) == {"a": 5, "b": 747, "c": 748}
    assert language_crf.quotas({"a": 3}, 1500) == {"a": 3} and language_crf.quotas({}, 10) == {}


def test_texts_without_letters_or_labels_teach_nothing(spark, odd):
    none = spark.createDataFrame([(1, "123 !!", "de"), (2, None, "de"), (3, "Wort", None)], "doc_id long, text string, lang string")
    assert language_crf.training_rows(none) == []
    assert {r.lang_pred for r in language_crf.predict(odd.drop("lang_pred"), None).collect()} == {"und"}


def test_a_batch_of_texts_is_cut_before_it_is_read():
    """A task makes Python texts for one chunk at a time, and a chunk is a megabyte."""
    import pyarrow as pa

    from millrace.llm import common

    texts = ["a" * 400, None, "é" * 300, "", "b" * 5000, "c"]
    cut = list(common.spans(pa.array(texts, pa.string()), 900))
    assert [texts[s] for s in cut] == [texts[:2], texts[2:4], texts[4:5], texts[5:]]
    assert common.CHUNK_CHARS <= 1_000_000 and list(common.spans(pa.array([], pa.string()))) == []
