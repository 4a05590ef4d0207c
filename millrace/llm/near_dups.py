"""Near-duplicates: SuperMinHash signatures, banding, verification, union-find.

Signatures. An element proposes to component p(j) the value r(j) + j, where p
is its own random permutation and r(j) is in [0, 1); a component keeps the
least value. Level j can no longer win once every component holds less than j,
so a document stops early: a text with many shingles after two or three
levels.

Candidates. Equal shingle sets are one node. Bands of ``ROWS`` components put
nodes into buckets. Each bucket names one hub and pairs it with its members;
after the verified links are joined, only members that are not in their
bucket's largest component are paired with the others, so a large group of
near copies costs one pair per member, not all pairs. In a bucket of more than
``CROWD`` members that still holds several components, a pair must also share
one of the rarest shingles of both, which every pair at the threshold does.
Pairs whose sizes or sampled signature bits rule the similarity out (4.5
standard deviations) are left; all others are confirmed on their full shingle
sets.

Groups are the connected components of the confirmed links, found by
alternating star contraction in Spark.

Defined results: a null or empty text has no shingles and is linked with
nothing; repeated rows are in one group; a null id is never the name of a group
that has another id, and stands alone if it has none.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_texts

WIDTH = 5
ROWS = 4
#: Chance that a pair just at the threshold shares no band.
MISS = 1e-5
BITS = 64
KNOWN_WORDS = 100_000
#: Characters of text whose signatures a task makes at once; their permutations take some twenty bytes a character.
CHUNK = 1_000_000
#: Members of a bucket that are paired directly.
CROWD = 32

_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def band_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, words remembered up to a bound."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            return np.array([known[w] for w in found], dtype=np.uint64)
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in found:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return np.array([known[w] for w in found], dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        w = self.words(text)
        n = len(w)
        if not n:
            return w
        width = min(n, WIDTH)
        total = np.full(n - width + 1, width, dtype=np.uint64)
        for i in range(width):
            total += mix(w[i : n - width + 1 + i] * _ODD[i])
        return np.unique(mix(total))


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """SuperMinHash of each set: float64 [sets, size]; an empty set keeps ``size`` everywhere."""
    best = np.full((len(sets), size), float(size))
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = None
    for level in range(size):
        if not len(element):
            break
        seed = mix(element + _U((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        value = (seed >> _U(11)).astype(np.float64) * 2.0**-53 + level
        pick = (mix(seed) % _U(size - level)).astype(np.int64) + level
        row = np.arange(len(element))
        if level == 0:
            place = pick
        else:
            place = places[row, pick].astype(np.int64)
            places[row, pick] = places[row, level]
        np.minimum.at(best.reshape(-1), owner * size + place, value)
        going = (best.max(axis=1) > level + 1)[owner]
        if level == 0:
            element, owner, pick = element[going], owner[going], pick[going]
            places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(element), 1))
            places[np.arange(len(element)), pick] = 0
        elif not going.all():
            element, owner, places = element[going], owner[going], places[going]
    return best


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    bits = mix(np.ascontiguousarray(signature).view(np.uint64))
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        total = np.full(len(signature), b + 1, dtype=np.uint64) * _ODD[4]
        for r in range(ROWS):
            total = mix(total + bits[:, ROWS * b + r] * _ODD[r])
        keys[:, b] = total
    return keys.view(np.int64)


def sampled_bits(signature: np.ndarray) -> np.ndarray:
    """Two words of one hashed bit for each of the first 64 components."""
    hashed = mix(np.ascontiguousarray(signature[:, :BITS]).view(np.uint64))
    weights = _U(1) << np.arange(hashed.shape[1], dtype=np.uint64)
    return np.stack([(((hashed >> _U(s)) & _U(1)) * weights).sum(axis=1, dtype=np.uint64) for s in (7, 41)], axis=1).view(np.int64)


PRINTS = "n_shingles long, digest binary, bands array<long>, bits_a long, bits_b long"


def prints(df: DataFrame, threshold: float, keep=("doc_id",), text: str = "text") -> DataFrame:
    """Per row: size and digest of its shingle set, band keys and signature bits (null without shingles)."""
    bands = band_count(threshold)
    size = max(BITS, bands * ROWS)

    def make():
        shingler = Shingler()

        def work(texts):
            sets = [shingler.shingles(t) for t in texts]
            made = signatures(sets, size)
            keys, bits = band_keys(made, bands), sampled_bits(made)
            full = [len(s) > 0 for s in sets]
            return (
                [len(s) for s in sets],
                [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                [k if ok else None for k, ok in zip(keys, full, strict=True)],
                [int(b) if ok else None for b, ok in zip(bits[:, 0], full, strict=True)],
                [int(b) if ok else None for b, ok in zip(bits[:, 1], full, strict=True)],
            )

        return work

    return map_texts(df, make, PRINTS, keep, text, CHUNK)


def shingle_sets(df: DataFrame, keep, text: str = "text") -> DataFrame:
    """``keep`` and the sorted shingle set of each text."""

    def make():
        shingler = Shingler()
        return lambda texts: [[shingler.shingles(t).view(np.int64) for t in texts]]

    return map_texts(df, make, "shingles array<long>", keep, text, CHUNK)


def components(edges: DataFrame, space, name: str) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (a, b), for nodes with an edge.

    Large and small star steps in turn until nothing changes. Each round is
    written, so lost executors cost one round at most.
    """
    star = space.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-0")
    before, step = None, 0
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        step += 1
        star = space.keep(small.where("u <> v").distinct(), f"{name}-{step}")
        space.drop(f"{name}-{step - 1}")
        # Sums of few hashes each stay far from the range's end, and stars of the same sum are the same.
        now = star.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**31 - 1)))).first()
        if now == before:
            return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now


def confirm(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("__a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("__b"))
    percent = round(100 * threshold)
    shared = F.size(F.array_intersect("__a", "__b"))
    union = F.size("__a") + F.size("__b") - shared
    return pairs.join(left, "a").join(right, "b").where(100 * shared >= percent * union).select("a", "b")


def plausible(threshold: float):
    """Sizes and sampled bits (columns ..._a and ..._b) allow the similarity."""
    percent = round(100 * threshold)
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    off = 1 - threshold
    spread = math.sqrt(BITS * threshold * off + BITS * off / 2)
    differ = F.bit_count(F.col("x_a").bitwiseXOR(F.col("x_b"))) + F.bit_count(F.col("y_a").bitwiseXOR(F.col("y_b")))
    return sizes & (differ <= math.ceil(BITS * off + 4.5 * spread))


def rare_marks(nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``nodes`` with ``mark``, one row for each of the rarest shingles of a node, rarest among ``nodes``.

    Of n shingles the rarest n - ceil(threshold n) + 1 are taken, in one order
    for all. Two sets that reach the threshold share one of them, so joining
    on marks loses no pair; shingles that no other node has are left out.
    """
    each = nodes.select("node", "n").join(sets, "node").select("node", "n", F.explode("shingles").alias("mark"))
    counts = each.groupBy("mark").agg(F.count("*").alias("c"))
    order = Window.partitionBy("node").orderBy("c", "mark")
    percent = round(100 * threshold)
    taken = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) + 1
    ranked = each.join(counts, "mark").withColumn("place", F.row_number().over(order)).where(F.col("place") <= taken)
    return ranked.where("c > 1").select("node", "mark", "place").join(nodes, "node")


def leading(threshold: float):
    """This mark (columns n and place) is among those with which the smaller set of a pair enters.

    A pair of n and m >= n shingles at the threshold t shares 2 t / (1 + t) n of
    them at least, so the smaller set needs fewer marks than the larger. Pages
    of a template that stay just under the threshold then meet by no mark.
    """
    percent = round(100 * threshold)
    return F.col("place") <= F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + 1


def meeting(marks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of nodes (columns ..._a and ..._b) by a shared mark; a is the smaller set, of equal sizes the lesser node."""
    few = _side(marks.where(leading(threshold)).withColumnRenamed("mark", "key"), "a")
    met = few.join(_side(marks.withColumnRenamed("mark", "key"), "b"), "key")
    return met.where((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))


def reachable(threshold: float):
    """Were this mark (columns place_a and place_b) the first that two sets share, they could still reach the threshold.

    All shared shingles then lie from the mark on, in either set. The first
    shared mark of a linked pair passes, so no link is lost.
    """
    percent = round(100 * threshold)
    most = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(
        F.col("node").alias(name),
        F.col("n").alias(f"n_{name}"),
        F.col("bits_a").alias(f"x_{name}"),
        F.col("bits_b").alias(f"y_{name}"),
        *[F.col(c).alias(f"{c}_{name}") for c in ("component", "place") if c in nodes.columns],
        *[c for c in ("key", "main") if c in nodes.columns],
    )


def group(df: DataFrame, space, threshold: float = 0.85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``text_key`` (hash of the text), ``n_shingles``, ``component_id``, ``class_id`` (a node, null without shingles)."""
    docs = df.select(F.col(key).alias("doc"), F.xxhash64(text).alias("text_key"), F.col(text).alias("__body"))
    made = prints(docs, threshold, ["doc", "text_key"], "__body").withColumn("row", F.monotonically_increasing_id())
    rows = space.keep(made, "prints")
    named = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("node"))
    nodes = space.keep(
        rows.select("row", "doc", "text_key", F.col("n_shingles").alias("n"), "bands", "bits_a", "bits_b")
        .join(named.select(F.col("node").alias("row")), "row")
        .withColumnRenamed("row", "node"),
        "nodes",
    )
    placed = nodes.select("node", "n", "bits_a", "bits_b", F.explode("bands").alias("key"))
    counts = placed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = placed.join(counts, "key")
    # The hub of a bucket is its member with the most neighbours over all its buckets: near copies gather around their source.
    fame = shared.groupBy("node").agg(F.sum("members").alias("fame"))
    shared = space.keep(shared.join(fame, "node"), "shared")
    hubs = shared.groupBy("key").agg(F.max(F.struct("fame", "node"))["node"].alias("hub"))
    members = space.keep(shared.drop("fame").join(hubs, "key"), "members")

    # Shingle sets of all nodes that share a bucket, each from one document.
    live = members.select("node").distinct()
    wanted = nodes.join(live, "node").select("node", F.col("doc").alias("__doc"), F.col("text_key").alias("__key"))
    texts = docs.join(wanted, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key")))
    sets = space.keep(shingle_sets(texts, ["node"], "__body").dropDuplicates(["node"]), "sets")

    likely = plausible(threshold)
    first = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    small = nodes.select("node", "n", "bits_a", "bits_b")
    first = first.join(_side(small, "a"), "a").join(_side(small, "b"), "b").where(likely).select("a", "b")
    links = space.keep(confirm(first, sets, threshold), "links-1")
    joined = components(links, space, "round-1")

    # Where a bucket holds several components: those outside its largest against all others.
    held = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("hub")
    held = space.keep(held, "held")
    sizes = held.groupBy("key", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("most"), F.count("*").alias("parts"))
    several = largest.where("parts > 1").select("key", F.col("most.component").alias("main"))
    open_ones = space.keep(held.join(several, "key"), "open")
    few = open_ones.where(F.col("members") <= CROWD)
    rest = _side(few.where("component <> main").drop("main"), "a")
    others = _side(few, "b")
    once = (F.col("component_b") == F.col("main")) | (F.col("a") < F.col("b"))
    apart = F.col("component_a") != F.col("component_b")
    second = rest.join(others, "key").where(apart & once & likely).select("a", "b")
    # In a crowded bucket most pairs fail, so there a pair must share a rare shingle too.
    crowd = open_ones.where(F.col("members") > CROWD).select("node", "n", "bits_a", "bits_b", "component").distinct()
    marks = space.keep(rare_marks(crowd, sets, threshold), "marks")
    third = meeting(marks, threshold).where(apart & reachable(threshold) & likely).select("a", "b")
    second = second.unionByName(third).distinct()
    more = space.keep(confirm(second, sets, threshold), "links-2")
    final = components(links.unionByName(more), space, "round-2")
    # What is left to read are the prints and the last round.
    space.drop("nodes", "shared", "members", "sets", "links-1", "held", "open", "marks", "links-2")

    nodes_of = named.join(final, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    grouped = rows.join(nodes_of, "digest", "left")
    names = grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("doc").alias("least"))
    out = grouped.join(names, "component", "left")
    name = F.when(F.col("component").isNull(), F.col("doc")).otherwise(F.col("least"))
    return out.select(F.col("doc").alias(key), "text_key", "n_shingles", name.alias("component_id"), F.col("component").alias("class_id"))


def survivors(df: DataFrame, space, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one with the least id, with all columns of ``df``; of repeated rows one.

    Rows without shingles each stand alone and stay. Rows without an id are
    kept where their group has no id at all.
    """
    stay = group(df, space, threshold, key, text).where(F.col(key).eqNullSafe(F.col("component_id")))
    # Of several texts under the least id, that of the least hash; a row without shingles is a group of its own text.
    own = F.when(F.col("class_id").isNull(), F.struct(F.col(key), F.col("text_key")))
    stay = stay.groupBy("class_id", own.alias("own")).agg(F.min(F.struct("text_key", key)).alias("one"))
    stay = stay.select(F.col(f"one.{key}").alias("__id"), F.col("one.text_key").alias("__text"))
    hashed = df.withColumn("__hash", F.xxhash64(text))
    found = hashed.join(stay, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text")), "left_semi")
    return found.dropDuplicates([key, "__hash"]).select(*df.columns)
