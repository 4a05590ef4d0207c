"""Conversation structure repair by generalised LR parsing.

A conversation's roles have to follow a grammar. Its LR(0) automaton is built
from the productions; reductions that need no lookahead are done at once, so a
stack top is a state over a shared stack below it. The repair reads rows in
order and keeps a graph-structured stack with several tops at once, each with
the least (cost, audit) of the edits that lead to it: a row is kept (shift of
its own role), reroled (shift of another role) or deleted (no shift), and a row
can be inserted (a shift that reads nothing). Equal tops are merged by minimum
(cost, audit). At the end the least accepting top gives the repair. Of one
audit there is one repair: in each top of this grammar one role can be shifted
by an edit, so the letters tell the roles.

Rows of a conversation pass one task in order as a stream, as an ordered hash
over all its texts is part of the result; none is collected. Two passes: the
first moves rows without texts (a digest tells duplicates) and gives the audit,
one letter per edit; the second sorts the audit ahead of its rows and hashes
the repaired texts on the way. What a task holds of a conversation is a byte
per row and, for conversations of more than ``BLOCK`` rows, a pointer per
block: these are solved from the end by costs alone, then block by block.

Defined results: null ids, turns, roles and texts read as one space, while null
turns sort first and do not count as gaps; rows of one turn are ordered by role
and then by the MD5 of their text, so equal rows stand together; an empty role has no
initial and fits nothing; a very long text is one row's value; a null ``conv_id``
is a conversation of its own; an empty table gives no row. Only the four named
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Damage, faults and costs of the contract.
DAMAGES = 20
DROP, EMPTY, UNPOINT, REPEAT, AS_USER = range(5)
SPACE = " \t\n\x0b\x0c\r"
POINTS = ".!?"
LEGAL_PAIRS = ("su", "ua", "au")
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 4, 3, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: ``(s?(ua)+)?``
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
#: Rows whose audits are compared as texts; longer conversations go block by block.
BLOCK = 512

Cost = tuple[int, str]
ENDLESS = 1 << 60


class Automaton:
    """LR(0) states of a grammar, and the stacks (graph nodes) that its shifts reach.

    ``shift[top][letter]`` is the set of tops after reading a letter,
    ``accepts`` the tops at which the input may end. A node is a state and the
    node below it, made once, so equal tops are one node. Grammars whose stacks
    grow without end are refused beyond ``most`` nodes.
    """

    def __init__(self, grammar: Sequence[tuple[str, str]] = GRAMMAR, most: int = 256):
        self.grammar = tuple(grammar)
        self.names = {left for left, _ in grammar}
        self.letters = sorted({c for _, right in grammar for c in right} - self.names)
        start = self._closed({(i, 0) for i, (left, _) in enumerate(grammar) if left == grammar[0][0]})
        self.nodes: list[tuple[frozenset, int]] = [(start, -1)]
        known = {self.nodes[0]: 0}
        self.shift: list[dict[str, tuple[int, ...]]] = []
        self.accepts: list[bool] = []
        for top in self._each():
            options = {}
            for letter in self.letters:
                reached = self._settled(top, letter, known)
                if reached:
                    options[letter] = tuple(reached)
            self.shift.append(options)
            self.accepts.append(self._ends(top))
            if len(self.nodes) > most:
                raise ValueError("the grammar's stacks have no bound")

    def _each(self) -> Iterator[int]:
        top = 0
        while top < len(self.nodes):
            yield top
            top += 1

    def _closed(self, items) -> frozenset:
        items, open_ = set(items), list(items)
        while open_:
            rule, dot = open_.pop()
            right = self.grammar[rule][1]
            for i, (left, _) in enumerate(self.grammar):
                if dot < len(right) and right[dot] == left and (i, 0) not in items:
                    items.add((i, 0))
                    open_.append((i, 0))
        return frozenset(items)

    def _goto(self, state: frozenset, symbol: str) -> frozenset:
        return self._closed({(r, d + 1) for r, d in state if d < len(self.grammar[r][1]) and self.grammar[r][1][d] == symbol})

    def _push(self, top: int, symbol: str, known: dict) -> int | None:
        state = self._goto(self.nodes[top][0], symbol)
        if not state:
            return None
        node = (state, top)
        if node not in known:
            known[node] = len(self.nodes)
            self.nodes.append(node)
        return known[node]

    def _settled(self, top: int, letter: str, known: dict) -> list[int]:
        """Tops after a shift; a state that can only reduce does so at once."""
        found, open_ = [], [self._push(top, letter, known)]
        while open_:
            node = open_.pop()
            if node is None:
                continue
            state = self.nodes[node][0]
            done = [r for r, d in state if d == len(self.grammar[r][1]) and self.grammar[r][0] != self.grammar[0][0]]
            if len(done) < len(state):
                found.append(node)
            for rule in done:
                left, right = self.grammar[rule]
                below = node
                for _ in right:
                    below = self.nodes[below][1]
                open_.append(self._push(below, left, known))
        return sorted(set(found))

    def _ends(self, top: int) -> bool:
        """Whether a whole-input production is complete here."""
        return any(d == len(self.grammar[r][1]) and self.grammar[r][0] == self.grammar[0][0] for r, d in self.nodes[top][0])


#: A row as a letter: its role's initial, in upper case if truncated; DELETED if it has to go; UNKNOWN for other roles.
DELETED, UNKNOWN, UNKNOWN_CUT = "-", "?", "!"


def read_code(code: str) -> tuple[str, int]:
    """Initial and extra cost of an undeleted row."""
    if code == UNKNOWN_CUT:
        return UNKNOWN, TRUNCATED_COST
    return code.lower(), TRUNCATED_COST if code.isupper() else 0


class Repair:
    """The weighted edits over an automaton's tops."""

    def __init__(self, automaton: Automaton | None = None, roles: Sequence[str] = tuple(ROLES)):
        self.automaton = automaton or Automaton()
        self.roles = tuple(roles)
        self.back = lru_cache(maxsize=100_000)(self._back)

    def _moves(self, top: int, letters) -> Iterator[int]:
        for letter in letters:
            yield from self.automaton.shift[top].get(letter, ())

    @staticmethod
    def _merge(tops: dict[int, Cost], top: int, cost: Cost) -> bool:
        if top in tops and tops[top] <= cost:
            return False
        tops[top] = cost
        return True

    def inserted(self, tops: dict[int, Cost]) -> dict[int, Cost]:
        """``tops`` and those that insertions reach."""
        tops, open_ = dict(tops), list(tops)
        while open_:
            top = open_.pop()
            cost, audit = tops[top]
            for after in self._moves(top, self.roles):
                if self._merge(tops, after, (cost + INSERT_COST, audit + "I")):
                    open_.append(after)
        return tops

    def read(self, tops: dict[int, Cost], code: str) -> dict[int, Cost]:
        """Tops after one row and any insertions before it."""
        after: dict[int, Cost] = {}
        for top, (cost, audit) in self.inserted(tops).items():
            self._merge(after, top, (cost + DELETE_COST, audit + "D"))
            if code != DELETED:
                initial, extra = read_code(code)
                for kept in self._moves(top, initial):
                    self._merge(after, kept, (cost + extra, audit + "K"))
                for changed in self._moves(top, self.roles):
                    self._merge(after, changed, (cost + extra + REROLE_COST, audit + "R"))
        return after

    def ends(self) -> tuple[int, ...]:
        """Least cost to the end of input per top, by insertions alone."""
        return tuple(
            min((cost for t, (cost, _) in self.inserted({top: (0, "")}).items() if self.automaton.accepts[t]), default=ENDLESS)
            for top in range(len(self.automaton.nodes))
        )

    def _back(self, code: str, togo: tuple[int, ...]) -> tuple[int, ...]:
        """Least cost to the end per top before a row, from those after it."""
        return tuple(
            min(cost + togo[t] for t, (cost, _) in self.read({top: (0, "")}, code).items()) for top in range(len(togo))
        )

    def solve(self, codes: str, block: int = BLOCK) -> Cost:
        """The least (cost, audit) that makes the rows a sentence of the grammar."""
        # From the end: costs at the block borders, less their minimum, so that few distinct ones occur.
        togo, borders = self.ends(), []
        for i in range(len(codes) - 1, 0, -1) if len(codes) > block else ():
            togo = self.back(codes[i], togo)
            least = min(togo)
            togo = tuple(c - least for c in togo)
            if i % block == 0:
                borders.append(togo)
        top, total, audits = 0, 0, []
        for start in range(0, max(1, len(codes)), block):
            tops = {top: (0, "")}
            for code in codes[start : start + block]:
                tops = self.read(tops, code)
            if start + block >= len(codes):
                cost, audit = min(c for t, c in self.inserted(tops).items() if self.automaton.accepts[t])
            else:
                rest = borders.pop()
                _, audit, top = min((cost + rest[t], audit, t) for t, (cost, audit) in tops.items())
                cost = tops[top][0]
            total += cost
            audits.append(audit)
        return total, "".join(audits)


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows of an audit, read along with the rows."""
    count = 0
    lead = False  # a kept system row comes first and is no part of the user/assistant turns

    def turn() -> str:
        return ROLES["ua"[(count - lead) % 2]]

    for letter in audit:
        if letter == "I":
            yield turn(), ""
        else:
            role, text = next(rows)
            if letter == "D":
                continue
            if letter == "K":
                lead = lead or (not count and role[:1] == "s")
                yield role, text
            else:
                yield turn(), text
        count += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` (0: dropped, 2: repeated) after the contract's damage."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % DAMAGES).alias("way")
    )
    text = F.when(F.col("way") == EMPTY, "").when(F.col("way") == UNPOINT, F.translate("text", POINTS, "")).otherwise(F.col("text"))
    role = F.when(F.col("way") == AS_USER, ROLES["u"]).otherwise(F.col("role"))
    copies = F.when(F.col("way") == DROP, 0).when(F.col("way") == REPEAT, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def _digest():
    return F.unhex(F.md5(F.col("text").cast("binary")))


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def faults(rows: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """Per conversation of :func:`damaged` the counts of :data:`FOUND`, under its id."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    last = F.substring(trimmed, -1, 1)
    state = F.when(trimmed == "", 2).when(last.isin(*POINTS), 0).otherwise(1)
    bare = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "copies", state.alias("state"))
    seen = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = bare.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(seen).alias("at"))
    marks = first.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).alias("copies"), F.lit(0).alias("state"), F.lit(0).alias("kind"))
    # A mark stands right ahead of the first row of its role and text.
    both = bare.withColumn("kind", F.lit(1)).unionByName(marks).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", "kind")
    both = both.select("conv_id", "turn", "role", "copies", "state", "kind")
    fields = T.StructType([both.schema["conv_id"]] + T.StructType.fromDDL(FOUND).fields)
    arrow = to_arrow_schema(fields)

    def run(batches):
        repair = Repair(automaton)
        for conv, rows in _conversations(batches):
            codes, counts, turns, illegal = bytearray(), [0, 0, 0], [], 0
            distinct, previous, fresh = 0, None, False
            for turn, role, copies, state, kind in rows:
                if not kind:
                    fresh = True
                    continue
                for _ in range(copies):
                    initial = role[:1]
                    if previous is not None and previous + initial not in LEGAL_PAIRS:
                        illegal += 1
                    previous = initial
                    if turn is not None:
                        if not turns:
                            turns = [turn, turn]
                        distinct += not distinct or turn != turns[1]
                        turns[1] = turn
                    fault = 0 if state == 2 else 1 if not fresh else 2 if state else 3
                    fresh = False
                    if fault < 3:
                        counts[fault] += 1
                    known = initial in ("s", "u", "a")
                    code = DELETED if fault < 2 else (UNKNOWN_CUT if fault == 2 else UNKNOWN) if not known else initial.upper() if fault == 2 else initial
                    codes += code.encode()
            gaps = turns[1] - turns[0] + 1 - distinct if turns else 0
            cost, audit = repair.solve(codes.decode())
            yield conv, gaps, *counts, illegal, cost, audit

    return both.mapInArrow(_emitting(run, arrow), fields)


def _conversations(batches) -> Iterator[tuple]:
    """(conv_id, its other columns row by row) of a stream sorted by conv_id; rows are read as they are asked for."""

    def flat():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    stream = flat()
    waiting = next(stream, None)

    def rest(conv):
        nonlocal waiting
        while waiting is not None and waiting[0] == conv:
            row, waiting = waiting, None
            yield row[1:]
            waiting = next(stream, None)

    while waiting is not None:
        conv = waiting[0]
        rows = rest(conv)
        yield conv, rows
        for _ in rows:
            pass


def _emitting(run, arrow: pa.Schema, rows: int = 1000, chars: int = 4_000_000):
    """Batches of what ``run`` yields row by row."""

    def work(batches):
        made, size = [], 0
        for row in run(batches):
            made.append(row)
            size += len(row[-1])
            if len(made) == rows or size > chars:
                yield _batch(made, arrow)
                made, size = [], 0
        if made:
            yield _batch(made, arrow)

    return work


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's row of ``found`` ahead of its rows in order, every copy a row."""
    names = [c for c in found.columns if c != "conv_id"]
    each = rows.where("copies > 0").select("conv_id", "turn", "role", "text", _digest().alias("digest"), F.explode(F.sequence(F.lit(1), "copies")).alias("kind"))
    leads = found.select("conv_id", F.lit(0).alias("kind"), F.struct(*names).alias("found"))
    both = each.unionByName(leads, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", F.col("kind") > 0, F.asc_nulls_first("turn"), "role", "digest")
    return both.select("conv_id", "found", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place`` (from 0), ``role, text``."""
    stream = _with_audits(rows, found)
    fields = T.StructType([stream.schema["conv_id"]] + T.StructType.fromDDL("place long, role string, text string").fields)

    def run(batches):
        for conv, rows in _conversations(batches):
            audit = next(rows)[0]["audit"]
            for place, (role, text) in enumerate(repaired(audit, (r[1:] for r in rows))):
                yield conv, place, role, text

    return stream.mapInArrow(_emitting(run, to_arrow_schema(fields)), fields)


def repair(conversations: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """Per conversation the faults after damage, the least cost and audit, and the hash of its repaired rows."""
    rows = damaged(conversations)
    stream = _with_audits(rows, faults(rows, automaton))
    fields = T.StructType([stream.schema["conv_id"]] + T.StructType.fromDDL(FOUND + ", repaired_sha256 string").fields)

    def run(batches):
        for conv, rows in _conversations(batches):
            found = next(rows)[0]
            sha = hashlib.sha256()
            for place, (role, text) in enumerate(repaired(found["audit"], (r[1:] for r in rows))):
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield conv, *found.values(), sha.hexdigest()

    return stream.mapInArrow(_emitting(run, to_arrow_schema(fields)), fields)
