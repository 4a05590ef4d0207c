"""Conversation repair and the filter audit against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm.conftest import bag, prose
from millrace import Workspace
from millrace.llm import conversation_repair as repair
from millrace.llm import filter_audit as audit

GRAMMAR = re.compile("(s?(ua)+)?")


def cheapest(codes):
    """Least (cost, audit) by trying every audit of up to n + 3 letters."""
    best = None
    for extra in range(4):
        for places in itertools.combinations_with_replacement(range(len(codes) + 1), extra):
            inserts = Counter(places)
            for edits in itertools.product("DKR", repeat=len(codes)):
                letters, heads, cost = "", "", 3 * extra
                for i in range(len(codes) + 1):
                    letters += "I" * inserts[i]
                    heads += "i" * inserts[i]
                    if i == len(codes):
                        break
                    edit, (initial, more) = edits[i], repair.read_code(codes[i]) if codes[i] != "-" else ("-", None)
                    if edit == "D":
                        cost += 4
                    elif more is None:
                        break
                    else:
                        cost += more + (3 if edit == "R" else 0)
                        heads += initial if edit == "K" else "i"
                    letters += edit
                else:
                    continue
                if letters.count("D") + letters.count("K") + letters.count("R") < len(codes):
                    continue
                if not fits(heads):
                    continue
                best = min(best or (cost, letters), (cost, letters))
    return best


def fits(heads):
    """Whether the rows written i (free to be user or assistant) can make a sentence."""
    for lead in ("", "s"):
        rest = heads[len(lead) :]
        if heads.startswith(lead) and len(rest) % 2 == 0 and all(c in ("i", "ua"[k % 2]) for k, c in enumerate(rest)) and (rest or not lead):
            return True
    return False


def test_cheapest_edits_and_ties():
    solver, r = repair.Repair(), random.Random(4)
    for n in range(5):
        for _ in range(40):
            codes = "".join(r.choice("suaSUA-?!") for _ in range(n))
            assert solver.solve(codes) == cheapest(codes), codes


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_blocks_change_nothing(block):
    solver, r = repair.Repair(), random.Random(block)
    for _ in range(60):
        codes = "".join(r.choice("suauaUA-?") for _ in range(r.randint(0, 90)))
        assert solver.solve(codes, block) == solver.solve(codes, 10_000), codes


def test_long_conversations_take_linear_time():
    cost, letters = repair.Repair().solve("?" * 100_001)
    assert cost == 4 + 3 * 100_000 and letters == "D" + "R" * 100_000


def test_other_grammars():
    calls = repair.Automaton((("C", ""), ("C", "T"), ("T", "ut"), ("T", "Tut")))
    assert calls.letters == ["t", "u"]
    with pytest.raises(ValueError):
        repair.Automaton((("C", "T"), ("T", "u"), ("T", "uTa")))  # nested turns have no bound


SCHEMA = "conv_id long, turn long, role string, text string, cost int, audit string, kind int"


def by_hand(rows):
    """Faults, cheapest repair and hash of each conversation in plain Python."""
    after, all_ids = defaultdict(list), set()
    blank = lambda x: " " if x is None else x
    for conv, turn, role, text, *_ in rows:
        all_ids.add(conv)
        way = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        after[conv] += [(turn, "user" if way == 4 else role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    for conv in all_ids:
        lines = sorted(after[conv], key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))
        turns = [t for t, _, _ in lines if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, codes, counts = set(), "", [0, 0, 0]
        for _, role, text in lines:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not stripped else 1 if (role, text) in seen else 2 if stripped[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            head = role[:1] if role[:1] in ("s", "u", "a") else "?"
            codes += "-" if fault in (0, 1) else head if fault is None else "!" if head == "?" else head.upper()
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:], strict=False))
        cost, letters = cheapest(codes)
        out, queue = [], iter(lines)
        for letter in letters:
            row = None if letter == "I" else next(queue)
            if letter == "K":
                out.append((row[1], row[2]))
            elif letter != "D":
                before = len([x for x in out if x[0][:1] != "s" or x is not out[0]])
                out.append(("user" if before % 2 == 0 else "assistant", row[2] if row else ""))
        text = "\n".join(f"{a}:{b}" for a, b in out)
        yield (conv, gaps, *counts, illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def test_repair_of_awkward_rows(spark):
    r = random.Random(11)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(r.randint(1, 4)):
            text = r.choice([None, "", " \n", "Same.", "cut", prose(r.randrange(9), 6) + ".", "Ende!\x0b", "é中文😀?"])
            rows.append((conv, r.choice([turn, turn, turn, 2 * turn, None]), r.choice(["user", "assistant", "assistant", "system", "", None, "tool"]), text, 1, "x", 9))
    rows += [(900, None, None, None, 1, "x", 9), (901, 1, "user", prose(1, 20_000), 1, "x", 9), rows[3], rows[3]]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = repair.repair(table)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert bag(map(tuple, got.collect())) == bag(by_hand(rows))
    damaged = repair.damaged(table)
    lines = repair.repaired_rows(damaged, repair.faults(damaged)).collect()
    by_conv = defaultdict(list)
    for line in lines:
        by_conv[line.conv_id].append((line.place, line.role, line.text))
    hashes = {conv: hashlib.sha256("\n".join(f"{a}:{b}" for _, a, b in sorted(x)).encode()).hexdigest() for conv, x in by_conv.items()}
    assert all(hashes.get(x.conv_id, hashlib.sha256(b"").hexdigest()) == x.repaired_sha256 for x in got.collect())
    for x in by_conv.values():
        assert GRAMMAR.fullmatch("".join(a[:1] for _, a, _ in sorted(x)))
    assert repair.repair(table.limit(0)).collect() == []


def test_a_conversation_of_many_rows(spark):
    """A third of the rows in one conversation, all of one text or of none that repeats."""
    rows = [(7, i, "user", "Again and again." if i % 2 else f"Line {i}.") for i in range(6000)] + [(100 + i, 0, "user", "Hi.") for i in range(9000)]
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == 9001
    big = got[7]
    kept = sum(0 if zlib.crc32(f"7:{i}".encode()) % 20 == 0 else 2 if zlib.crc32(f"7:{i}".encode()) % 20 == 3 else 1 for i in range(6000))
    assert len(big.audit.replace("I", "")) == kept and big.audit.count("D") >= big.duplicate + big.blank


def masks_by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search("[#$%&*|]", text)), i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        ]
        docs.append((lang or "", fails, i in good, i in toxic))
    return docs


def audit_by_hand(rows, labels):
    docs = masks_by_hand(rows, labels)
    out, removals = {}, Counter()
    for order in itertools.permutations(range(5)):
        name = "".join("ABCDE"[f] for f in order)
        for part in {d[0] for d in docs}:
            mine = [d for d in docs if d[0] == part]
            for step, f in enumerate(order):
                left = [d for d in mine if not any(d[1][g] for g in order[:step])]
                gone = [d for d in left if d[1][f]]
                removals[part, f] += len(gone)
                failing = [d for d in mine if d[1][f]]
                out[part, name, step + 1] = (
                    len(left) - len(gone), len(gone), len(failing) - len(gone), sum(sum(d[1]) == 1 for d in failing),
                    sum(d[2] for d in gone), sum(d[3] for d in gone), f,
                )
    return sorted((*key, *value[:-1], removals[key[0], value[-1]]) for key, value in out.items())


def run_audit(docs, labels, **size):
    rows = audit.document_rows(audit.matrix(docs, Workspace(docs.sparkSession), **size))
    return audit.audit(audit.masks(rows, labels))


def test_audit_of_awkward_rows(spark, odd, none, rows):
    more = [(200 + i, prose(i % 5, 120) + " A B C" * (40 * (i % 2)) + "#" * (i % 3 == 0), "fr") for i in range(20)]
    more += [(300, "b " * 40_000, ""), (301, "b " * 40_000, None), (300, "b " * 40_000, "fr")]
    langs = ["en", "de", None]
    table = odd.select("doc_id", "text", "lang", "kept", "row").unionByName(
        spark.createDataFrame([(*m, "x", 1) for m in more], "doc_id long, text string, lang string, kept string, row int")
    )
    flat = [(i, t, langs[n % 3]) for n, (i, t) in enumerate(rows)] + more
    labels = [(i, i % 2, i % 3) for i in range(0, 240, 3)] + [(0, 1, 1), (None, 1, 1), (3, None, None), (300, 1, 0)]
    table_of_labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, run_audit(table, table_of_labels).collect()))
    assert got == audit_by_hand(flat, labels)
    assert sorted(map(tuple, run_audit(table, table_of_labels, chars=3000).collect())) == got  # many small shards
    assert run_audit(none, table_of_labels).collect() == []
    assert {r.good_lost for r in run_audit(table, table_of_labels.limit(0)).collect()} == {0}


def test_matrix_is_the_counts_of_words(spark):
    texts = [(i, prose(i, 30 + i)) for i in range(25)] + [(90, "w " * 70_000 + "v"), (91, None), (92, "")]
    table = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "null AS lang").repartition(4)
    got, words = {}, {}
    for r in audit.matrix(table.selectExpr("doc_id", "text", "cast(lang AS string) lang"), Workspace(spark), chars=2000).collect():
        for i, doc in enumerate(r.doc_ids):
            counts = Counter()
            for k in range(r.starts[i], r.starts[i + 1]):
                counts[r.codes[r.columns[k]]] += r.counts[k]
            got[doc] = counts
    for doc, text in texts:
        want = Counter((text or "").split())
        assert sorted(want.values()) == sorted(got[doc].values())
        words.setdefault(doc, want)
    # One code per word across shards: documents share as many codes as words.
    for a, b in itertools.combinations(got, 2):
        assert sum((got[a] & got[b]).values()) == sum((words[a] & words[b]).values())


def test_a_shard_moves_in_rows_of_bounded_size(spark):
    """Two megabytes of text in one shard: no row holds more than a block of them or a slice of the dictionary."""
    texts = [(i, prose(i, 6000), "en") for i in range(60)] + [(60 + i, "", "en") for i in range(6000)]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1)
    sizes = {i: len(t) for i, t, _ in texts}
    parts = audit.shards(table).collect()
    assert {r.shard for r in parts} == {0} and sum(len(r.doc_ids or ()) for r in parts) == len(texts)
    assert max(sum(len(c) for c in (r.columns, r.counts, r.words) if c) for r in parts) < 200_000
    blocks = audit.matrix(table, Workspace(spark)).collect()
    assert {r.shard for r in blocks} == {0} and len(blocks) >= 4
    for r in blocks:
        assert sum(sizes[i] for i in r.doc_ids) <= 500_000 and len(r.doc_ids) <= 5000
        assert len(r.codes) == len(set(r.codes)) == len(set(r.columns))
    got = {r.doc_id: (r.n_words, r.n_distinct) for r in audit.document_rows(audit.matrix(table, Workspace(spark))).collect()}
    assert got == {i: (len(t.split()), len(set(t.split()))) for i, t, _ in texts}
