"""Near-duplicates against all pairs; signatures against the definition."""

import random

import numpy as np
import pytest

from millrace import Workspace
from millrace.llm import near_dups
from llm.conftest import bag, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def grouped(rows, percent):
    """(doc_id, size, least id of its component) over all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    names = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            names[root(a)] = min(i, names.get(root(a), i))
    return [(i, len(sets[a]), names.get(root(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)]


def edited(text, edits, r):
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def chain(seed, copies, words, most):
    """Copies of one text with more and more edits, and some edited from one another."""
    r = random.Random(seed)
    base = prose(seed, words)
    made = [base]
    for i in range(copies):
        made.append(edited(r.choice(made) if i % 3 == 0 else base, r.randint(1, most), r))
    return made


@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_groups(spark, rows, threshold):
    texts = chain(1, 120, 150, 12) + chain(2, 30, 400, 12) + chain(3, 10, 9, 1) + [f"{prose(4, 60)} {prose(50 + i, 12)}" for i in range(50)]
    texts += ["one two", "ONE  two", "one two three four five", "ÉÉ a", "éé a"]
    docs = rows + [(1000 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = near_dups.group(frame, Workspace(spark), threshold).select("doc_id", "n_shingles", "component_id").collect()
    assert bag(map(tuple, got)) == bag(grouped(docs, round(100 * threshold)))


def family(shared, own, n, start=0):
    """``n`` sets that share ``shared`` shingles and have ``own`` more each."""
    return [(start + i, list(range(shared)) + [10**6 + 1000 * (start + i) + j for j in range(own)]) for i in range(n)]


def met(spark, sets, threshold):
    nodes = spark.createDataFrame([(i, len(s), 0, 0, i) for i, s in sets], "node long, n long, bits_a long, bits_b long, component long")
    shingled = spark.createDataFrame(sets, "node long, shingles array<long>")
    return near_dups.meeting(near_dups.rare_marks(nodes, shingled, threshold), threshold)


def test_pages_of_a_template_under_the_threshold_never_meet(spark):
    # 90 of 110 shingles are shared: each page enters with 9 marks and has 10 of its own.
    for n in (500, 2000):
        assert met(spark, family(90, 10, n), 0.85).count() == 0


@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_shorter_marks_lose_no_pair(spark, threshold):
    r = random.Random(5)
    base = list(range(60))
    sets = []
    for i in range(150):
        kept = [x for x in base if r.random() > r.choice([0.02, 0.08, 0.2])]
        sets.append((i, kept + [10**6 + r.randrange(400) for _ in range(r.randrange(8))]))
    sets = [(i, sorted(set(s))) for i, s in sets] + family(17, 3, 5, 200)
    percent = round(100 * threshold)
    order = lambda x: (len(x[1]), x[0])
    want = set()
    for x in sets:
        for y in sets:
            a, b = set(x[1]), set(y[1])
            if order(x) < order(y) and 100 * len(a & b) >= percent * len(a | b):
                want.add((x[0], y[0]))
    rows = met(spark, sets, threshold).where(near_dups.reachable(threshold)).select("a", "b").distinct().collect()
    assert len(want) > 100 and want <= set(map(tuple, rows))


def test_family_at_the_threshold(spark):
    """Pages of two templates, one just under the threshold and one over it, in crowded buckets."""
    under, over = prose(60, 94), prose(61, 94)
    texts = [f"{under} {prose(1000 + i, 10)}" for i in range(150)] + [f"{over} {prose(3000 + i, 4)}" for i in range(150)]
    docs = list(enumerate(texts))
    got = near_dups.group(spark.createDataFrame(docs, "doc_id long, text string"), Workspace(spark), 0.85)
    assert bag(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == bag(grouped(docs, 85))


def test_awkward_rows_and_survivors(odd, none, spark):
    kept = near_dups.survivors(odd, Workspace(spark)).collect()
    ids = [r.doc_id for r in kept]
    # 107 and 108 are document 3 and a few words more.
    assert len(ids) == len(set(ids)) and {3, 100, 101, 102, None} <= set(ids) and not {107, 108} & set(ids)
    assert kept[0].asDict().keys() == set(odd.columns)
    assert near_dups.survivors(none, Workspace(spark)).collect() == []
    assert near_dups.group(none, Workspace(spark)).collect() == []


def slow_signature(values, size):
    """SuperMinHash of one set with a full permutation per element and no early stop."""
    best = [float(size)] * size
    for x in values:
        p = list(range(size))
        for level in range(size):
            seed = near_dups.mix(np.array([x], np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            value = float(seed[0] >> np.uint64(11)) * 2.0**-53 + level
            pick = int(near_dups.mix(seed)[0] % np.uint64(size - level)) + level
            p[level], p[pick] = p[pick], p[level]
            best[p[level]] = min(best[p[level]], value)
    return best


def test_signature_stops_early_without_loss():
    r = np.random.default_rng(1)
    sets = [r.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 5, 40, 300, 0, 64)]
    got = near_dups.signatures(sets, 32)
    for row, values in zip(got, sets, strict=True):
        assert row.tolist() == slow_signature(values, 32)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        common, a, b = (r.integers(0, 2**63, n).astype(np.uint64) for n in (60, 20, 20))
        one, two = near_dups.signatures([np.concatenate([common, a]), np.concatenate([common, b])], 128)
        errors.append((one == two).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components(spark):
    r = random.Random(3)
    path = [(i, i + 1) for i in range(40)]
    others = [(100 + r.randrange(60), 100 + r.randrange(60)) for _ in range(45)]
    edges = path + others + others[:5]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for x in parent}
    got = near_dups.components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark), "t").collect()
    assert {x.node: x.component for x in got} == {x: c for x, c in want.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert len(got) == len({x.node for x in got})
    assert near_dups.components(spark.createDataFrame([], "a long, b long"), Workspace(spark), "t").collect() == []
