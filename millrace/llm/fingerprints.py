"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a weighted set: each lower-cased word weighs its count. For every
word and every one of ``SAMPLES`` samples there are fixed draws r, c ~ Gamma(2, 1)
and b ~ U(0, 1). A weight w gives t = floor(ln w / r + b), y = exp(r (t - b)) and
a = c / (y e^r); the word of the least a, with its t, is the sample. Two
documents share a sample with the probability of their generalised Jaccard
similarity (the sum of least weights over the sum of greatest), so the share of
equal samples estimates it.

A word is its 64-bit hash. Its draws come from two small tables, broadcast: r
from the row that one part of the hash names, c and b from the row of another
part, so two words have the same draws with a chance of 2**-30, whatever the
number of words, and differ in their hashes even then. A sample is the minimum
of one long that holds a, 27 bits of the word's hash and t, so all samples are
plain hash aggregates that combine before anything moves.

``edited`` puts documents into buckets of consecutive ids, shuffles each text
once, and adds the first document of the next bucket to each as an extra row,
so a text meets its neighbour without a second shuffle. All that follows keeps
that one shuffle's buckets: hashes and lengths go along with the words, and a
row without a word stays a row, so no join has to bring them back.

Buckets are cut by id and, where one id (or none) fills several of them, by the
hash of the text as well, so no id is one task.

Defined results: a null text is an empty one; a text without words has the
empty fingerprint, whose likeness is 1 to itself and 0 to any other; repeated
rows are neighbours of each other, rows of one id go by the hash of their
text; null ids come last; a very long text is one row's value, its words are
counted before anything moves. A single document is its own neighbour. An empty
table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of each table of draws, named by disjoint bits of a word's hash.
TERM_BITS = 15
TERMS = 1 << TERM_BITS
SAMPLES = 64
#: A sample keeps ln a in steps of 2**-28 from -64 on, then 27 bits of the word's hash, the last 12 of them changed by t.
STEPS, LOW, WORD_BITS = 28, 64.0, 27


def draws(spark: SparkSession, terms: int = TERMS, samples: int = SAMPLES) -> DataFrame:
    """term, and arrays of r, ln c and b for its samples."""

    def uniform(k: Column, n: int) -> Column:
        return (F.shiftrightunsigned(F.xxhash64(F.lit(n), F.col("term"), k), 12).cast("double") + 0.5) / float(2**52)

    def gamma(k: Column, n: int) -> Column:
        return -F.log(uniform(k, n) * uniform(k, n + 1))

    each = F.sequence(F.lit(0), F.lit(samples - 1))
    return spark.range(terms).select(F.col("id").cast("int").alias("term")).select(
        "term",
        F.transform(each, lambda k: gamma(k, 1).cast("float")).alias("r"),
        F.transform(each, lambda k: F.log(gamma(k, 3)).cast("float")).alias("lc"),
        F.transform(each, lambda k: uniform(k, 5).cast("float")).alias("b"),
    )


def sample(k: int) -> Column:
    """The long whose minimum over a document's words is its sample ``k``; columns lw, r, lc, b and ``low``, the word's bits."""
    r, lc, b = (F.col(c).getItem(k).cast("double") for c in ("r", "lc", "b"))
    t = F.floor(F.col("lw") / r + b)
    la = lc - r * (t - b) - r
    high = F.floor((F.greatest(F.lit(-LOW), F.least(F.lit(LOW), la)) + LOW) * float(2**STEPS))
    return F.shiftleft(high, WORD_BITS).bitwiseOR(F.col("low").bitwiseXOR(t.bitwiseAND(F.lit(4095))))


def words(text: Column) -> Column:
    return F.split(F.lower(text), r"\s+")


def fingerprints(texts: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``samples`` (a long each) of every row, null where it has no word; ``keys`` name a row."""
    spark = texts.sparkSession
    # A split text has one part at least, maybe an empty one, so every row stays.
    exploded = texts.select(*keys, F.explode(words(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    hashed = F.when(F.col("word") != "", F.xxhash64("word"))
    counted = exploded.groupBy(*keys, hashed.alias("word")).agg(F.count("*").alias("n"))
    part = lambda from_bit: F.coalesce(F.shiftrightunsigned("word", from_bit).bitwiseAND(F.lit(TERMS - 1)).cast("int"), F.lit(0))
    named = counted.select(
        *keys, F.log("n").alias("lw"), F.col("word").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).alias("low"), part(64 - TERM_BITS).alias("term"), part(64 - 2 * TERM_BITS).alias("other")
    )
    table = draws(spark, samples=samples)
    drawn = named.join(F.broadcast(table.select("term", "r")), "term").join(F.broadcast(table.select(F.col("term").alias("other"), "lc", "b")), "other")
    least = drawn.groupBy(*keys).agg(*[F.min(sample(k)).alias(f"s{k}") for k in range(samples)])
    return least.select(*keys, F.when(F.col("s0").isNotNull(), F.array(*[f"s{k}" for k in range(samples)])).alias("samples"))


def shown(samples: Column) -> Column:
    """A fingerprint as text: four hex digits a sample; empty without samples."""
    digits = F.transform(samples, lambda s: F.lpad(F.lower(F.hex(F.pmod(F.hash(s), F.lit(65536)))), 4, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; null stands for the empty fingerprint."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    both = F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0))
    return both.otherwise(equal / F.size(a).cast("double"))


def bucket_of(value: Column, cuts: list[float], hashed: Column | None = None, none: int = 1) -> Column:
    """A number that rises with ``value`` and, inside a value that holds several of the ascending ``cuts``, falls with ``hashed``.

    Rows without a value have the first ``none`` numbers, by hash as well.
    """
    share = F.lit(0.0) if hashed is None else hashed.cast("double") / float(2**64) + 0.5
    part = lambda count: count - 1 - F.least(F.floor(share * count), count - 1).cast("int")
    if not cuts:
        return F.when(value.isNull(), part(F.lit(none))).otherwise(F.lit(none))
    # Each cut once, with how many lie below it and at it; found by halving, in one fold. Written as
    # one text each, as a literal of every number makes plans that fill the driver.
    kinds = sorted(set(cuts))
    listed = lambda numbers, kind: F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")
    each = listed(map(float, kinds), "double")
    below, at_it = listed(map(cuts.index, kinds), "int"), listed(map(cuts.count, kinds), "int")
    steps = []
    step = 1 << (len(kinds).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1

    def halve(at, step):
        here = at + step
        cut = F.try_element_at(each, F.least(here, F.lit(len(kinds))))
        return F.when((here <= len(kinds)) & (cut < value.cast("double")), here).otherwise(at)

    def number(passed):
        first = passed + 1  # the first cut that is not below the value
        low = F.coalesce(F.try_element_at(below, first), F.lit(len(cuts)))
        if hashed is None:
            return low
        at_value = F.try_element_at(each, first) == value.cast("double")
        return low + part(F.when(at_value, F.try_element_at(at_it, first)).otherwise(1))

    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve, number)
    return F.when(value.isNull(), part(F.lit(none))).otherwise(none + place)


def edited(docs: DataFrame, space, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    The edited text ends, in place of its own last half (rounded down), with
    as many first characters of the next document by descending id; after the
    last comes the first. ``parts`` is the number of tasks, by default four for
    each shuffle partition.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = 2 * parts
    quantiles = [i / wanted for i in range(1, wanted)]
    ids = docs.select(F.col(key).cast("double").alias("k"))
    cuts = sorted(ids.approxQuantile("k", quantiles, 0.25 / wanted))
    count, without = ids.agg(F.count("*"), F.count_if(F.col("k").isNull())).first()
    none = 1 + wanted * without // max(1, count)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        bucket_of(F.col(key), cuts, F.xxhash64(body), none).alias("bucket"), F.col(key).alias("id"), F.xxhash64(body).alias("hash"), body.alias("body")
    )
    # The first row of each bucket, and the bucket that it follows: one row per bucket.
    order = F.struct(F.col("id").isNull().alias("none"), (-F.col("id")).alias("minus"), F.col("hash").alias("hash"))
    firsts = rows.groupBy("bucket").agg(F.min(order).alias("o"), F.lit(0).alias("all"))
    firsts = space.keep(firsts.select("bucket", "o.none", (-F.col("o.minus")).alias("id"), F.col("o.hash").alias("hash"), "all"), "firsts")
    whole = Window.partitionBy("all").orderBy("bucket")
    after = firsts.select("id", "hash", F.coalesce(F.lead("bucket").over(whole), F.first("bucket").over(whole)).alias("to"))
    same = rows["id"].eqNullSafe(F.col("__id")) & (rows["hash"] == F.col("__hash"))
    named = after.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), "to")
    edges = rows.join(F.broadcast(named), same).groupBy("to").agg(F.first("body").alias("body"))
    edges = space.keep(edges, "edges")
    extra = edges.select(
        F.coalesce("to", F.lit(0)).alias("bucket"), F.lit(None).cast(docs.schema[key].dataType).alias("id"), F.lit(None).cast("long").alias("hash"), "body", F.lit(1).alias("edge")
    )
    dealt = rows.withColumn("edge", F.lit(0)).unionByName(extra).repartition(parts, "bucket")
    line = Window.partitionBy("bucket").orderBy("edge", F.col("id").desc_nulls_last(), "hash")
    placed = dealt.select("bucket", "id", "edge", "body", F.row_number().over(line).alias("pos"), F.lead("body").over(line).alias("next"))
    half = F.floor(F.length("body") / 2).cast("int")
    changed = F.concat(
        F.substring(F.col("body"), F.lit(1), F.length("body") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)
    )
    placed = placed.withColumn("changed", changed)
    # Three lines a row: its text, its edited text, and what else is known of it, which is null on the
    # lines with words and so costs them nothing. Nothing is joined to a row afterwards.
    known = F.struct("id", "edge", F.length("body").cast("long").alias("n_chars"), F.sha2(F.col("changed").cast("binary"), 256).alias("sha"))
    line = lambda at, text, note: F.struct((F.col("pos") * 3 + at).alias("line"), text.alias("t"), note.alias("known"))
    three = F.array(line(0, F.col("body"), F.lit(None)), line(1, F.col("changed"), F.lit(None)), line(2, F.lit(""), known))
    made = fingerprints(placed.select("bucket", F.inline(three)), ["bucket", "line", "known"], "t")
    along = Window.partitionBy("bucket").orderBy("line")
    beside = {"own": F.lag("samples", 2), "other": F.lag("samples", 1), "following": F.lead("samples", 1)}
    lines = made.withColumns({name: column.over(along) for name, column in beside.items()})
    out = lines.where("known.edge = 0").select("known.*", *beside)
    return out.select(
        F.col("id").alias(key),
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
