"""Personal data, plain and disguised, with spans of the source text.

Base patterns find e-mail and IP addresses, payment cards and phone numbers in
the text as it is. For disguised ones a cascade of transducers rewrites the
text: look-alike and wide characters become ASCII and invisible ones go; runs
of spelled digits become digits; disguised "at" and "dot" signs become signs.
Each transducer is a list of edits, and the rewritten text carries for each of
its characters the span of the source it comes from. The base patterns run
again over the rewritten text, and a match that holds a rewritten character is
mapped back to the source and added, unless it lies inside a base span.

What counts as a disguise is narrow, so that prose stays as it is: letters of
another script are rewritten only in words that become ASCII as a whole; spelled
digits only in runs of three or more, or beside a disguised sign; a bare word "at"
only before a name and a disguised "dot"; signs in brackets or between spaces
only inside what then is an address.

Defined results: a null or empty text has no spans and the hash of an empty
string; repeated rows are scanned one by one; texts are scanned whole in time
linear in their length, with two offsets a character held only for a text that
is rewritten; equal starts are ordered by kind, and equal spans of one kind are
one; an empty table gives an empty result; a kept column named like a result
gives way to it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bared, map_texts, shielded

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that none goes back over a run.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: what can stand before an @ goes back to the last match or the first other character."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each four numbers of a dotted run, whatever their size; too large ones are dropped after."""
    for run in DOTTED.finditer(text):
        parts = run.group().split(".")
        if len(parts) < 4:
            continue
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                yield run.start() + (int(ends[i - 1]) + 1 if i else 0), run.start() + int(ends[i + 3])


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(map(str.isdigit, m.group())) <= PHONE_DIGITS[1]:
                yield m.span()


NO_DIGITS = bytes(set(range(256)) - set(b"0123456789"))


def base_spans(text: str) -> list[Span]:
    # No pattern but the first fits fewer than four digits.
    digits = len(text.encode("utf-8", "surrogatepass").translate(None, NO_DIGITS))
    finders = (emails, addresses, cards, phones) if digits >= 4 else (emails,)
    return sorted((start, kind, end) for kind, find in enumerate(finders) for start, end in find(text))


class Rewritten:
    """A text under rewriting: for each character its source span and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.starts: np.ndarray | None = None

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the spans of ``edits`` (sorted, apart) by their texts."""
        if not edits:
            return
        if self.starts is None:
            self.starts = np.arange(len(self.text), dtype=np.int32)
            self.ends = self.starts + 1
            self.new = np.zeros(len(self.text), dtype=bool)
        texts, starts, ends, new, at = [], [], [], [], 0
        for start, end, text in edits:
            texts += [self.text[at:start], text]
            starts += [self.starts[at:start], np.full(len(text), self.starts[start], dtype=np.int32)]
            ends += [self.ends[at:start], np.full(len(text), self.ends[end - 1], dtype=np.int32)]
            new += [self.new[at:start], np.ones(len(text), dtype=bool)]
            at = end
        self.text = "".join([*texts, self.text[at:]])
        self.starts, self.ends = np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]])
        self.new = np.concatenate([*new, self.new[at:]])

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of a span, and whether it holds anything rewritten or left out."""
        first, last = int(self.starts[start]), int(self.ends[end - 1])
        return first, last, bool(self.new[start:end].any()) or last - first != end - start


# Letters of other scripts that look like ASCII ones, and signs with the same use.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "օ": "o", "ѐ": "e",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "。": ".", "․": ".", "·": ".", "‧": ".", "ⓐ": "@",
}
# Digits, signs and "plus" in English, German, French and Spanish.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
TIMES_WORDS = {"double": 2, "triple": 3}
PLUS_WORDS = ("plus", "más")
AT_WORDS = ("at", "arobase", "arroba")
DOT_WORDS = ("dot", "punkt", "point", "punto")
#: Ranges in which compatible forms of ASCII characters lie.
COMPATIBLE = ((0x80, 0x3400), (0xF900, 0x10000), (0x1D400, 0x1D800), (0x1F100, 0x1F1A0), (0x1FBF0, 0x1FBFA))
LEAST_RUN = 3
#: "look at the dot com": no host is named by an article.
ARTICLES = frozenset("a an the this that der die das le la les el los las".split())


def character_table() -> dict[str, str]:
    """What each character outside ASCII is rewritten to: compatible forms, decimal digits, look-alikes; "" for invisible ones."""
    table = {}
    for first, end in COMPATIBLE:
        for c in map(chr, range(first, end)):
            plain = unicodedata.normalize("NFKC", c)
            if unicodedata.category(c) == "Nd":
                table[c] = str(unicodedata.decimal(c))
            elif unicodedata.category(c) == "Cf":
                table[c] = ""
            elif plain != c and plain.isascii():
                table[c] = plain
    return {**table, **LOOKALIKES}


def _either(words) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_OPEN, _CLOSE, _GAP = r"[\[({<]\x20{0,2}", r"\x20{0,2}[\])}>]", r"\x20{1,3}"
_EDGE, _STOP = r"(?<![^\W_])", r"(?![^\W_])"
BRACKET_AT = rf"\x20{{0,2}}{_OPEN}(?:{_either(AT_WORDS)}|@){_CLOSE}\x20{{0,2}}"
BARE_AT = rf"{_GAP}(?:{_either(AT_WORDS)}){_GAP}"
SPACED_AT = rf"{_GAP}@\x20{{0,3}}|@{_GAP}"
DISGUISED_DOT = rf"(?:\x20{{0,2}}{_OPEN}(?:{_either(DOT_WORDS)}|\.){_CLOSE}\x20{{0,2}}|{_GAP}(?:{_either(DOT_WORDS)}){_GAP}|{_GAP}\.{_GAP})"
AT = re.compile(rf"(?P<bracket>{BRACKET_AT})|(?P<bare>{BARE_AT})|(?P<spaced>{SPACED_AT})|@", re.IGNORECASE)
DOT = re.compile(rf"(?P<disguised>{DISGUISED_DOT})|\.", re.IGNORECASE)
DOT_BEFORE = re.compile(rf"{DISGUISED_DOT}\Z", re.IGNORECASE)
LABEL = re.compile(r"[A-Za-z0-9-]++")
LAST_LABEL = re.compile(r"[A-Za-z]{2,24}\Z")
NUMBERS = re.compile(rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}(?:(?:{DISGUISED_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9A-Za-z])", re.IGNORECASE)
#: The longest disguised dot, and what a disguised at has before its word, for looking back.
DOT_CHARS, AT_CHARS = 20, 5

_DIGIT = rf"(?:(?:{_either(TIMES_WORDS)})\x20)?(?:{_either(DIGIT_WORDS)}|[0-9]{{1,4}})"
_WORD = rf"{_EDGE}(?:{_DIGIT}|{_either(DOT_WORDS)}){_STOP}"
SPELLED = re.compile(rf"(?:{_EDGE}(?:{_either(PLUS_WORDS)})\x20|\+)?{_WORD}(?:[\x20,-]{{1,3}}{_WORD})*+", re.IGNORECASE)
SPELLED_PART = re.compile(rf"(?P<plus>{_either(PLUS_WORDS)})|(?:(?P<times>{_either(TIMES_WORDS)})\x20)?(?P<word>{_either(DIGIT_WORDS)})|(?P<dot>{_either(DOT_WORDS)})", re.IGNORECASE)
#: All words that a transducer reads, and the letters and digits between other characters.
WORDS = frozenset([*DIGIT_WORDS, *AT_WORDS, *DOT_WORDS, *PLUS_WORDS])
WORD_BYTES = {w.encode(): w for w in WORDS}
#: Letters, digits and bytes of wide characters as they are, the rest of ASCII as spaces.
PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
BRACKETS, BRACKET_DOT = "[({<", re.compile(r"[\[({<]\x20{0,2}\.")
#: How far the runs of two words may lie apart: separators around a number.
RUN_GAP = 12
RUN_CHARS = frozenset("0123456789 ,-+")
LETTERS = re.compile(r"[^\W\d_]+")


def wide_characters(text: str) -> set[str]:
    """The characters outside ASCII."""
    return set(text.encode("utf-8", "surrogatepass").translate(None, bytes(range(128))).decode("utf-8", "surrogatepass"))


def character_edits(text: str, table: dict[str, str]) -> list[tuple[int, int, str]]:
    """Edits of single characters; in a word that stays outside ASCII its letters stay."""
    odd = sorted(wide_characters(text) & table.keys())
    if not odd:
        return []
    edits, word = [], (-1, -1, True)
    for m in re.finditer("[" + "".join(map(re.escape, odd)) + "]", text):
        at = m.start()
        if text[at].isalpha():
            if not word[0] <= at < word[1]:
                start = at
                while start > word[1] and text[start - 1].isalpha():
                    start -= 1
                found = LETTERS.match(text, at)
                end = found.end() if found else at + 1
                word = (start, end, all(c.isascii() or c in table for c in text[start:end]))
            if not word[2]:
                continue
        edits.append((at, m.end(), table[text[at]]))
    return edits


def known_words(text: str) -> list[tuple[int, int, str]]:
    """(start, end, lower case) of the words that transducers read."""
    low = text.lower()
    if len(low) != len(text):  # a letter that becomes two: its place would be lost
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    apart = low
    for c in () if text.isascii() else wide_characters(low):
        apart = apart if c.isalnum() else apart.replace(c, " ")
    tokens = set(apart.encode("utf-8", "surrogatepass").translate(PLAIN).split())
    found = []
    for word in WORD_BYTES.keys() & tokens:
        word, at = WORD_BYTES[word], -1
        while (at := apart.find(word, at + 1)) >= 0:
            end = at + len(word)
            if not (at and apart[at - 1].isalnum()) and not apart[end : end + 1].isalnum():
                found.append((at, end, word))
    return sorted(found)


def run_windows(text: str, words: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Where a run of spelled digits can lie: two known words near each other, or one beside a number."""
    i = 0
    while i < len(words):
        j = i
        while j + 1 < len(words) and words[j + 1][0] - words[j][1] <= RUN_GAP:
            j += 1
        start, end = words[i][0], words[j][1]
        while start and text[start - 1] in RUN_CHARS:
            start -= 1
        if start and text[start - 1].isalnum() and start < words[i][0]:  # "double one": the word before may belong to it
            while start and text[start - 1].isalnum():
                start -= 1
        while end < len(text) and text[end] in RUN_CHARS:
            end += 1
        if any(w in DIGIT_WORDS for *_, w in words[i : j + 1]) and (j > i or any(c.isdigit() for c in text[start:end])):
            yield start, min(len(text), end + 1)
        i = j + 1


def spelled_edits(text: str, words: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits of spelled digits and of the gaps between the digits of a run."""
    edits = []
    for m in (m for window in run_windows(text, words) for m in SPELLED.finditer(text, *window)):
        parts = [p for p in SPELLED_PART.finditer(text, m.start(), m.end())]
        spelled = sum(p["word"] is not None for p in parts)
        figures = len(re.findall("[0-9]+", m.group()))
        dots = sum(p["dot"] is not None for p in parts)
        if not spelled or spelled < figures or (spelled + figures < LEAST_RUN and not dots):
            continue
        at, glue = m.start(), False
        tokens = re.finditer(rf"[0-9]+|{SPELLED_PART.pattern}", m.group(), re.IGNORECASE)
        for t in tokens:
            start, end = m.start() + t.start(), m.start() + t.end()
            sign = t["dot"] is not None
            if glue and not sign and start > at:
                edits.append((at, start, ""))  # the gap between two digits
            if t["plus"]:
                edits.append((start, end, "+"))
            elif t["word"]:
                edits.append((start, end, DIGIT_WORDS[t["word"].lower()] * TIMES_WORDS.get((t["times"] or "").lower(), 1)))
            at, glue = end, not sign
    return edits


def sign_edits(text: str, words: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Edits of disguised at and dot signs that make an address."""
    edits, done = [], 0
    signed = " . " in text or any(b in text for b in BRACKETS) and BRACKET_DOT.search(text)
    if signed or any(w in DOT_WORDS for *_, w in words):
        for m in NUMBERS.finditer(text):
            dots = [d for d in DOT.finditer(text, m.start(), m.end())]
            edits += [(d.start(), d.end(), ".") for d in dots if d["disguised"]]
    places = [m.start() for m in re.finditer("@", text)] if "@" in text else []
    for place in sorted(places + [start for start, _, w in words if w in AT_WORDS]):
        at = AT.search(text, max(done, place - AT_CHARS)) if place >= done else None
        if not at or not at.start() <= place < at.end():
            continue
        start, end = at.span()
        hidden = [] if at.group() == "@" else [(start, end, "@")]
        label, dots, last = LABEL.match(text, end), [], None
        stop = end
        while label:
            stop, last = label.end(), label
            dot = DOT.match(text, stop)
            label = LABEL.match(text, dot.end()) if dot else None
            if label:
                dots.append(dot)
        while dots and not LAST_LABEL.search(text, dots[-1].end(), stop):
            stop, dots = dots[-1].start(), dots[:-1]  # "x at y dot com dot 5" ends with com
        masked = [(d.start(), d.end(), ".") for d in dots if d["disguised"]]
        fits = last is not None and dots and start > done and text[start - 1] in LOCAL
        if at["bare"] and fits:
            fits = LABEL.match(text, end).group().lower() not in ARTICLES
        if fits and (masked if at["bare"] or not hidden else True) and (masked or hidden):
            before, head = [], start
            while head > done and text[head - 1] in LOCAL:
                while head > done and text[head - 1] in LOCAL:
                    head -= 1
                dot = DOT_BEFORE.search(text, max(done, head - DOT_CHARS), head)
                if not dot or dot.start() <= done or text[dot.start() - 1] not in LOCAL:
                    break
                before.append((dot.start(), dot.end(), "."))
                head = dot.start()
            edits += before + hidden + masked
            done = stop
    edits.sort()
    return [e for i, e in enumerate(edits) if not i or e[0] >= edits[i - 1][1]]


class Scanner:
    """The transducers with their tables, made once per task."""

    def __init__(self):
        self.table = character_table()

    def rewritten(self, text: str) -> Rewritten:
        new = Rewritten(text)
        if not text.isascii():
            new.apply(character_edits(text, self.table))
        words = known_words(new.text)
        edits = spelled_edits(new.text, words)
        if edits:
            new.apply(edits)
            words = known_words(new.text)
        new.apply(sign_edits(new.text, words))
        return new

    def hidden_spans(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the base patterns see only in the rewritten text."""
        new = self.rewritten(text)
        if new.starts is None:
            return []
        found = set()
        for start, kind, end in base_spans(new.text):
            first, last, hidden = new.source(start, end)
            if hidden and not any(s <= first and last <= e for s, k, e in base):
                found.add((first, kind, last))
        return sorted(found)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans by start, then kind."""
        base = base_spans(text)
        return base, sorted(base + self.hidden_spans(text, base))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCAN = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(df: DataFrame, keep=("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, counts and hash of the base spans, and all spans as text."""

    def make():
        scanner = Scanner()

        def work(texts):
            rows = []
            for text in texts:
                base, spans = scanner.spans(text or "")
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in range(4)), digest, spans_text(spans)))
            return list(zip(*rows, strict=True))

        return work

    return map_texts(df, make, SCAN, keep, text)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span replaced by ``[kind]``; overlapping spans become one, named by the first. Null texts stay null."""

    def make():
        scanner = Scanner()

        def work(texts):
            out = []
            for text in texts:
                text, parts, at = text or "", [], 0
                for start, kind, end in scanner.spans(text)[1]:
                    if start >= at:
                        parts += [text[at:start], f"[{KINDS[kind]}]"]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]))
            return [out]

        return work

    plain, names = shielded(df)
    made = map_texts(plain, make, "__made string", plain.columns, names[text])
    return bared(made.withColumn(names[text], F.when(F.col(names[text]).isNotNull(), F.col("__made"))), names)
