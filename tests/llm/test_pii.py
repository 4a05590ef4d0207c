"""Personal data: base patterns as stated, disguises with their source spans."""

import hashlib
import random
import re
import time
import unicodedata

import pytest

from llm.conftest import bag, prose
from millrace.llm import pii


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def stated(text):
    """The base spans with the patterns as stated, failing matches dropped."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def card(r, n=16):
    body = "".join(r.choice("0123456789") for _ in range(n - 1))
    return next(body + d for d in "0123456789" if luhn(body + d))


def test_base_patterns_as_stated():
    r = random.Random(1)
    alphabet = ["a", "b9", "@", ".", "-", "+", " ", "1", "22", "255", "256", "0", "(", ")", "x@y.z", "1.2.3.4", "é", "中", "\n", "+49 151 ", "%", "_"]
    for _ in range(3000):
        text = "".join(r.choice([*alphabet, card(r), "4111-1111 1111 1111"]) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(text) == stated(text), text


DISGUISED = [
    ("email", "bob [at] example [dot] com"), ("email", "bob(at)example.com"), ("email", "bob at example dot com"), ("email", "bob@example dot com"),
    ("email", "bob dot smith at mail dot example dot org"), ("email", "bоb@exаmple.com"), ("email", "ｂｏｂ＠example．com"),
    ("email", "bob arroba ejemplo punto es"), ("email", "bob {AT} example {DOT} com"), ("email", "bob @ example.com"), ("email", "bob@exa​mple.com"),
    ("ip", "192[.]168[.]1[.]10"), ("ip", "10 dot 0 dot 0 dot 1"), ("ip", "١٠.0.0.1"), ("ip", "one nine two dot one six eight dot one dot one"),
    ("card", " ".join(["four"] + ["one"] * 15)), ("card", "4111​1111​1111​1111"), ("card", "４111 1111 1111 1111"),
    ("card", "four double one one 1111 one one one one one one one one"),
    ("phone", "plus four nine one five one two three four five six seven"), ("phone", "+49 one five one 2345 678 nine"), ("phone", "＋49 (151) 234‑567"),
]


@pytest.mark.parametrize("kind, text", DISGUISED)
def test_disguises(kind, text):
    scanner = pii.Scanner()
    for before, after in (("", ""), ("Ask café \U0001f600, ", ", soon."), ("Zürich:\n", "\nEnde"), (prose(3, 30) + " or ", ".")):
        base, spans = scanner.spans(before + text + after)
        assert base == [] and spans == [(len(before), pii.KINDS.index(kind), len(before) + len(text))], (before, spans)


@pytest.mark.parametrize(
    "text",
    ["We are at example.com today.", "Look at the dot com bubble.", "one dot two", "double three", "at noon. dot", "почта моя", "m² @ 5", "un deux trois",
     "one two three four five six seven eight nine ten", "Meet at ten to four, at point five.", "version 1.2.3", prose(5, 400)],
)
def test_prose_stays(text):
    assert pii.Scanner().spans(text) == ([], [])


def test_plain_and_disguised_together():
    text = "a@b.example or c [at] d.example, 1.2.3.4 and 1[.]2[.]3[.]4; bob@mail.example dot com"
    base, spans = pii.Scanner().spans(text)
    assert base == stated(text)
    assert [text[s:e] for s, _, e in spans] == [
        "a@b.example", "c [at] d.example", "1.2.3.4", "1[.]2[.]3[.]4", "bob@mail.example", "bob@mail.example dot com",
    ]


def test_offsets_survive_random_rewriting():
    """Any rewriting keeps each rewritten character's source inside the source, in order."""
    r, scanner = random.Random(2), pii.Scanner()
    odd = sorted(scanner.table)
    for _ in range(300):
        text = "".join(r.choice([*odd[:: len(odd) // 40], "a", "1", " ", "one ", " dot ", " at ", "@", "é", "ж"]) for _ in range(r.randint(1, 30)))
        new = scanner.rewritten(text)
        if new.starts is None:
            continue
        assert len(new.text) == len(new.starts) == len(new.ends) == len(new.new)
        assert (new.starts[1:] >= new.starts[:-1]).all() and (new.ends <= len(text)).all() and (new.starts < new.ends).all()
        for c, start, end, changed in zip(new.text, new.starts, new.ends, new.new, strict=True):
            assert changed or text[start:end] == c


def test_table_holds_what_it_says():
    for c, plain in pii.character_table().items():
        assert plain.isascii() and not c.isascii() and len(c) == 1
        assert c in pii.LOOKALIKES or plain in ("", unicodedata.normalize("NFKC", c)) or unicodedata.category(c) == "Nd"


@pytest.mark.parametrize("piece", ["x", "1", "1 ", "a@", "+1 ", "at ", "a dot ", "[", " ", "1.", "é", "аб", "@ ", "one ", "a at b dot c "])
def test_long_texts_take_linear_time(piece):
    scanner, times = pii.Scanner(), []
    for n in (100_000, 400_000):
        text = piece * (n // len(piece))
        start = time.process_time()
        scanner.spans(text)
        times.append(time.process_time() - start)
    assert times[1] < 10 * times[0] + 1


def test_find_and_redact(spark, odd, none, rows):
    extra = [(500, "x\ud83d".encode("utf-8", "replace").decode() + " bob [at] example [dot] com, +1 (743) 555-3824"), (501, "a@b.example a@b.example")]
    table = odd.select("doc_id", "text", "kept").unionByName(spark.createDataFrame([(*x, "k") for x in extra], "doc_id long, text string, kept string"))
    got = pii.find(table.withColumnRenamed("kept", "spans")).collect()
    want = []
    for i, text in [*rows, *extra]:
        base = stated(text or "")
        counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
        text_of = lambda x: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in x)
        want.append((i, *counts, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(pii.Scanner().spans(text or "")[1])))
    assert bag(map(tuple, got)) == bag(want) and len(got) == len(want)
    out = {r.doc_id: r.text for r in pii.redact(table).collect()}
    assert pii.redact(odd).columns == odd.columns
    assert out[500].endswith(" [email], [phone]") and out[501] == "[email] [email]" and out[100] is None
    assert pii.find(none).collect() == [] == pii.redact(none).collect()
