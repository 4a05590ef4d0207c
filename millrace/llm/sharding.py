"""Rendezvous hashing of stable record keys over weighted shards.

A record scores every shard by -weight / ln(u), with u drawn from a hash of
its key and the shard's name, and goes to the shard of the highest score. A
shard's score depends on nothing but key, name and weight, so one more shard
takes records only into itself, and removing one moves only its own records.

Defined results: a null key is hashed as an empty text and differs from no
other null key; a null text counts no bytes and has the crc32 of an empty
one; repeated rows share a shard and get slots of their own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which a shard's slots are dealt, so that no task numbers a whole shard.
PARTS = 256


def unit(key: Column, name: str) -> Column:
    """A number in (0, 1) from key and shard name, the same in every engine that has md5."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, F.lit(name)).cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**48))


def choose(key: Column, weights: Mapping[str, float]) -> Column:
    """Index of the shard of ``key``; ``weights`` maps shard names to positive weights, ties go to the lower index."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every shard needs a positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [
        F.struct((F.lit(-float(w)) / F.log(unit(text, name))).alias("score"), F.lit(-i).alias("minus"))
        for i, (name, w) in enumerate(weights.items())
    ]
    return (-(F.greatest(*scores) if len(scores) > 1 else scores[0])["minus"]).cast("int")


def even(n: int) -> dict[str, float]:
    """``n`` shards of equal weight, named by their number."""
    return {str(i): 1.0 for i in range(n)}


def assign(df: DataFrame, weights: Mapping[str, float], grown: Mapping[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, size, text_crc32, shard, and the shard if ``grown`` were in force."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return df.select(
        F.col(key),
        (F.length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        choose(F.col(key), weights).alias("shard"),
        choose(F.col(key), grown).alias("grown_shard"),
        F.monotonically_increasing_id().alias("__row"),
    )


def with_slots(assigned: DataFrame, key: str = "doc_id", parts: int = PARTS) -> DataFrame:
    """``assigned`` (a written table) with ``slot``, gapless from 0 in each shard.

    A shard is dealt into ``parts`` by a hash that includes the row's number,
    so even one repeated key spreads. Rows are numbered in their part; the
    counts of earlier parts, one row per shard and part, are added.
    """
    dealt = assigned.withColumn("__part", F.pmod(F.xxhash64(key, "__row"), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("shard", "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("shard", "__part").orderBy(key, "__row"))
    numbered = dealt.withColumn("__place", place).join(before, ["shard", "__part"])
    return numbered.withColumn("slot", (F.col("__before") + F.col("__place") - 1).cast("long")).drop("__row", "__part", "__place", "__before")


def shard(df: DataFrame, weights: Mapping[str, float], grown: Mapping[str, float], space, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shards and slots of all rows. ``space`` holds the digests (no text) between the two passes."""
    return with_slots(space.keep(assign(df, weights, grown, key, text), "assigned"), key)
