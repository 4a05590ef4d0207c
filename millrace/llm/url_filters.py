"""URL filters: host and path rules, then trust and distrust spread over the link graph of hosts.

A rule ``host/path`` fits its host and all subdomains where the path starts
with the rule's; the longest rule that fits decides. Where none does, the host
decides. Hosts most of whose pages a rule allows are trusted seeds, hosts most
of whose pages a rule blocks are blocked seeds. Trust follows links
(personalised PageRank that restarts at trusted seeds), distrust goes against
them (a page that links to a blocked host shares its distrust). A host whose
distrust exceeds its trust is blocked; a host that neither reaches is allowed.

All of it is DataFrame functions; each round is one join and one sum over
aggregated host edges, and ranks are written every few rounds, until no host's
mass has grown by more than a share of ``TOLERANCE`` since they were written
last. So every host that links lead to from a seed is reached, however far it
lies and however little mass it gets.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is blocked, as nothing vouches for it; null html has no
links; repeated rows are judged alike and weigh as pages each; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAMPING = 0.85
#: Rounds of :func:`ranks` where none are given; verdicts use :func:`settled`.
ROUNDS = 8
TOLERANCE = 1e-6
#: Rounds between written ranks.
WRITTEN = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link with a host: an attribute's value, with or without a scheme.
LINK = r"""(?:[hH][rR][eE][fF]|[sS][rR][cC])\s*=\s*["']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest of ``rules`` (texts like ``example.com/en/``) that fits, or null; the first of equals."""
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=len):
        name, slash, rest = rule.partition("/")
        inside = (host == name) | F.endswith(host, F.lit("." + name))
        found = F.when(inside & F.startswith(path, F.lit(slash + rest)) & (host != ""), F.lit(rule)).otherwise(found)
    return found


def parsed(pages: DataFrame, rules: dict[str, str], keep: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """``keep``, host, path and rule."""
    split = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return split.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), list(rules)))


def seeds(judged: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(way, host, mass): way 0 for trusted hosts, 1 for blocked ones; mass 1 each."""
    says = lambda verdict: F.coalesce(F.col("rule").isin([r for r, v in rules.items() if v == verdict]), F.lit(False)).cast("long")
    counts = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.sum(says("allow")).alias("allowed"), F.sum(says("block")).alias("blocked")
    )
    way = F.when(2 * F.col("allowed") > F.col("n"), 0).when(2 * F.col("blocked") > F.col("n"), 1)
    return counts.select(way.alias("way"), "host", F.lit(1.0).alias("mass")).where("way IS NOT NULL")


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(way, from, to, share): links between different hosts, forward for trust and reversed for distrust."""
    found = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("to"))
    links = found.select("src", F.translate("to", UPPER, LOWER).alias("dst")).where("src <> '' AND src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").alias("n"))
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("src").alias("from"), F.col("dst").alias("to"), "n"),
        F.struct(F.lit(1).alias("way"), F.col("dst").alias("from"), F.col("src").alias("to"), "n"),
    )
    both = links.select(F.inline(ways))
    out = both.groupBy("way", "from").agg(F.sum("n").alias("out"))
    return both.join(out, ["way", "from"]).select("way", "from", "to", (F.col("n") / F.col("out")).alias("share"))


def ranks(start: DataFrame, edges: DataFrame, space, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(way, host, mass) after ``rounds`` rounds of restart and spread."""
    restart = start.select("way", "host", (F.col("mass") * (1 - damping)).alias("mass"))
    now = restart
    for i in range(1, rounds + 1):
        moved = now.join(edges.withColumnRenamed("from", "host"), ["way", "host"])
        moved = moved.select("way", F.col("to").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
        now = restart.unionByName(moved).groupBy("way", "host").agg(F.sum("mass").alias("mass"))
        if i % WRITTEN == 0:
            now = space.keep(now, f"ranks-{i}")
    return now


def settled(start: DataFrame, edges: DataFrame, space, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(way, host, mass) of the converged spread; mass only grows from round to round, so the test sees new hosts too."""
    restart = start.select("way", "host", (F.col("mass") * (1 - damping)).alias("mass"))
    spread = edges.withColumnRenamed("from", "host")
    now, last = space.keep(restart, "ranks-0"), "ranks-0"
    i = 0
    while True:
        before = now
        for _ in range(WRITTEN):
            moved = now.join(spread, ["way", "host"])
            moved = moved.select("way", F.col("to").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
            now = restart.unionByName(moved).groupBy("way", "host").agg(F.sum("mass").alias("mass"))
        i += WRITTEN
        now = space.keep(now.where("mass > 0"), f"ranks-{i}")
        old = before.withColumnRenamed("mass", "old")
        grown = now.join(old, ["way", "host"], "left").agg(F.max(1 - F.coalesce("old", F.lit(0.0)) / F.col("mass"))).first()[0]
        space.drop(last)
        last = f"ranks-{i}"
        if grown is None or grown <= tolerance:
            return now


def judge(pages: DataFrame, rules: dict[str, str], space, keep: Sequence[str] = ("page_id",), url: str = "url", html: str = "html") -> DataFrame:
    """``keep``, host, path, rule and verdict of every page; ``rules`` maps a rule to ``allow`` or ``block``.

    A kept column named like one of the four gives way to it.
    """
    keep = [c for c in keep if c not in ("host", "path", "rule", "verdict")]
    judged = parsed(pages, rules, keep, url)
    start = space.keep(seeds(judged, rules), "seeds")
    edges = space.keep(host_edges(pages, url, html), "edges")
    mass = settled(start, edges, space)
    trust = F.coalesce(F.sum(F.when(F.col("way") == 0, F.col("mass"))), F.lit(0.0))
    distrust = F.coalesce(F.sum(F.when(F.col("way") == 1, F.col("mass"))), F.lit(0.0))
    bad = mass.groupBy(F.col("host").alias("__bad")).agg(trust.alias("t"), distrust.alias("d")).where("d > t").select("__bad")
    out = judged.join(bad, F.col("host") == F.col("__bad"), "left")
    ruled = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    own = F.when((F.col("host") == "") | F.col("__bad").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.when(F.col("rule").isNotNull(), F.element_at(ruled, F.col("rule"))).otherwise(own)
    return out.select(*keep, "host", "path", "rule", verdict.alias("verdict"))
