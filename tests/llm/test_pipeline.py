"""The pipeline's stages, each against plain Python on its own input, and the registered queries."""

import os
import subprocess
import sys
import zlib
from collections import Counter

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from compare import differences, duck
from millrace import Workspace
from millrace.llm import language_crf, quality_rules, queries, secrets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    space = Workspace(spark)
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = space.keep(stage(spark, docs, FOLDER), "stage")
        out[name] = (docs.collect(), made.collect(), docs.columns, made.columns)
        docs = made
    return out


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name][2] == stages[name][3] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rules(stages):
    before, after, _, _ = stages["quality rules"]
    keep = lambda t: not quality_rules.Text(t).base_failed and quality_rules.rejected(quality_rules.Text(t), quality_rules.RULES) is None
    assert Counter(after) == Counter(r for r in before if keep(r.text)) and 0 < len(after) < len(before)


def test_language(stages):
    before, after, _, _ = stages["language ID"]
    assert not Counter(after) - Counter(before) and len(after) >= 0.97 * len(before)


def test_one_of_each(stages):
    before, after, _, _ = stages["MinHash near-dedup"]
    from llm.test_near_dups import grouped

    names = grouped([(r.doc_id, r.text) for r in before], 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, _, name in names if i == name)
    assert not Counter(after) - Counter(before)


def test_secrets(stages):
    before, after, _, _ = stages["secret scan"]
    new = {r.doc_id: r for r in after}
    changed = 0
    for r in before:
        spans = secrets.base_spans(r.text)
        assert (new[r.doc_id].text == r.text) == (not spans) and not secrets.base_spans(new[r.doc_id].text)
        assert new[r.doc_id].n_chars == len(new[r.doc_id].text)
        changed += bool(spans)
    assert changed and len(new) == len(before)


def test_packing(stages):
    before, after, _, _ = stages["packing"]
    from llm.test_shards_packing import check_packing, ids_by_tokenizer
    from millrace.llm import packing

    ids = ids_by_tokenizer(packing.definition_of(queries.tokenizer_path()), [r.text for r in before])
    check_packing(after, {r.doc_id: i for r, i in zip(before, ids, strict=True)})
    for r in after:
        assert len(r.ids) == 4 * r.length


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in got.select("doc_id").collect()} == {r.doc_id for r in stages["packing"][1]}


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_queries(spark, key):
    assert differences(spark, FOLDER, duck(FOLDER), queries.QUERIES[key], queries.CHECKS.get(key)) is None


def test_entry_without_the_corpus_operators(tmp_path):
    """The entry point imports where this subpackage and the pipeline are absent."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "millrace"):
        source = os.path.join(root, name)
        if os.path.isfile(source):
            (tmp_path / name).symlink_to(source)
        else:
            (tmp_path / name).mkdir()
            for part in os.listdir(source):
                if part != "llm":
                    (tmp_path / name / part).symlink_to(os.path.join(source, part))
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import importlib.util as u; s = u.spec_from_file_location('e', {str(tmp_path / '__spark_entry__.py')!r}); m = u.module_from_spec(s); s.loader.exec_module(m); print(sum(k.startswith('op') or k == 'pipeline' for k in m.queries()), len(m.queries()))"
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, check=True).stdout.split()
    assert out[0] == "0" and int(out[1]) > 100




def test_language_stage_keeps_what_it_cannot_judge(spark, odd):
    """Without labels all stay; only long texts are learned from by windows; a given lang stays; texts without letters go."""
    bare = odd.withColumn("lang", F.lit(None).cast("string"))
    assert Counter(map(repr, corpus_pipeline.known_language(spark, bare, FOLDER).collect())) == Counter(map(repr, bare.collect()))
    long = [(i, "wort " * 6000 if i % 2 else "mot que " * 4000, "de" if i % 2 else "fr", None, None) for i in range(8)]
    more = [(50, "wort " * 30, None, None, None), (51, "mot que zzz kkk ppp", "fr", None, None), (52, "12 34", "fr", None, None), (53, None, "de", None, None)]
    docs = spark.createDataFrame(long + more, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, docs, FOLDER).collect()}
    assert kept == {**{i: "de" if i % 2 else "fr" for i in range(8)}, 50: "de", 51: "fr"}


def test_language_stage_learns_from_every_labelled_document(spark, monkeypatch):
    """Of whichever hash its id is; and every text is judged, with labels or without."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    fourth = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    others = [i for i in range(400) if i not in fourth]
    french, german = "mot que le la " * 20, "wort und der die " * 20
    bare = [(900, french, None, None, 1), (901, german, None, None, 1), (902, "12 34", None, None, 1), (903, "12 34", "fr", None, 1)]
    judged = []
    real = language_crf.predict
    monkeypatch.setattr(language_crf, "predict", lambda df, model, *more: judged.append(model and model.labels) or real(df, model, *more))

    def langs(rows):
        got = corpus_pipeline.known_language(spark, spark.createDataFrame(rows, schema), FOLDER).collect()
        return {r.doc_id: r.lang for r in got if r.doc_id >= 900}

    # A language that only ids of one hash have, then labels of that hash alone.
    rare = [(i, french, "fr", None, 1) for i in fourth[:8]]
    assert langs(rare + [(i, german, "de", None, 1) for i in others[:40]] + bare) == {900: "fr", 901: "de"}
    assert langs(rare + [(i, german, "de", None, 1) for i in fourth[8:40]] + bare) == {900: "fr", 901: "de"}
    assert langs(bare[:3]) == {900: None, 901: None, 902: None}
    assert judged == [["de", "fr"], ["de", "fr"], None]


def test_stages_on_awkward_and_empty_tables(spark, odd, none):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    space = Workspace(spark)
    for table in (odd.select(names), none.select(names)):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = space.keep(stage(spark, docs, FOLDER), "awkward")
            if name != "packing":
                assert docs.columns == names
        assert docs.count() == 0 or table is not none
