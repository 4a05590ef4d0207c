"""Ordered work inside groups of any size.

A plain ``Window.partitionBy(key).orderBy(...)`` sorts a whole key in one task,
so one key with a third of the rows decides the run time. Here each key is cut
into ranges of the order column, summed inside (key, range), and what the
earlier ranges of the same key contribute is added. The range totals are small,
so only they are windowed by key alone. Every input takes this one way. An
input that is costly to make should be written first: its order column is read
for the cuts, its keys and values for the range totals, and its rows once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import Workspace

_LOW, _TIE = "_range", "_tie_range"
#: Of the sketch that brackets percentiles: its ranks are off by a share of 1 / ACCURACY of the rows.
ACCURACY = 10_000
#: Share of the rows on either side of a wanted rank that its bracket spans at first.
MARGIN = 4 / ACCURACY
#: Counted values of one key that a plain window may sort in one task.
WINDOW_ROWS = 100_000


def _range_count(df: DataFrame) -> int:
    """A power of two, at least the number of shuffle partitions."""
    wanted = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return 1 << (wanted - 1).bit_length()


def _below(splits: Column, value: Column, count: int) -> Column:
    """How many of the sorted ``splits`` are smaller than ``value`` (binary search)."""
    steps = [count >> i for i in range(1, count.bit_length())]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda seen, step: seen + F.when(F.get(splits, seen + step - 1) < value, step).otherwise(0),
    )


def _measure(df: DataFrame, column: str) -> Column:
    """A number that rises with the column: itself, or the first six bytes of a text."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.StringType, T.BinaryType)):
        return F.col(column)
    head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("bigint")


def with_ranges(df: DataFrame, order: str, tie: str) -> DataFrame:
    """Add two order-preserving range numbers for ``(order, tie)``.

    Split points are quantiles of both columns, found in one aggregate. A value
    so frequent that it fills several quantiles gets a range of its own, which
    is cut again by the tie column. Texts are cut by their first bytes.
    """
    count = _range_count(df)
    at = F.array(*[F.lit(i / count) for i in range(1, count)])

    def cuts(column: str) -> Column:
        return F.percentile_approx(_measure(df, column), at, F.lit(max(10_000, 4 * count)))

    both = [cuts(order).alias("order"), *([] if tie == order else [cuts(tie).alias("tie")])]
    place = df.withColumn("_cuts", df.agg(F.struct(*both)).scalar()).withColumn("_at", _measure(df, order))
    place = place.withColumns({c: F.col(f"_cuts.{n}") for c, n in (("_orders", "order"), ("_ties", "tie")) if n == "order" or tie != order})
    place = place.withColumn("_seen", _below(F.col("_orders"), F.col("_at"), count))
    heavy = F.col(order).isNull() | (
        (F.get("_orders", F.col("_seen")) == F.col("_at")) & (F.get("_orders", F.col("_seen") + 1) == F.col("_at"))
    )
    if isinstance(df.schema[order].dataType, (T.StringType, T.BinaryType)):
        heavy = F.col(order).isNull()  # texts with the same first bytes still have an order of their own
    place = place.withColumn("_heavy", F.coalesce(heavy, F.lit(False)))
    low = F.when(F.col(order).isNull(), -1).otherwise(2 * F.col("_seen") + F.col("_heavy").cast("int"))
    if tie == order:
        place = place.withColumn(_TIE, F.lit(0))
    else:
        place = place.withColumn(
            _TIE, F.when(F.col("_heavy"), _below(F.col("_ties"), _measure(df, tie), count)).otherwise(0)
        )
    return place.withColumn(_LOW, low).drop("_cuts", "_orders", "_ties", "_seen", "_heavy", "_at")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    values: dict[str, Column | str],
    whole: bool = False,
    descending: bool = False,
) -> DataFrame:
    """Add, per entry of ``values``, its sum from the first row of the key up to this row.

    Rows are ordered by ``order`` and then ``tie`` (ascending); the pair must be
    unique within a key. A sum over nulls only is null. ``whole`` also adds
    ``<name>_whole``, the sum over the key.
    """
    columns = {name: F.col(v) if isinstance(v, str) else v for name, v in values.items()}
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    ranged = with_ranges(df, order, tie).withColumns({f"_v_{n}": c for n, c in columns.items()})
    part = [*keys, _LOW, _TIE]
    sums = ranged.groupBy(*part).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in columns])
    earlier = Window.partitionBy(*keys).orderBy(way(_LOW), F.col(_TIE)).rowsBetween(Window.unboundedPreceding, -1)
    key = Window.partitionBy(*keys)
    # What came before a range is one more row, sorted ahead of the range's own
    # rows. So it is added by the same window and the rows need no join.
    before = sums.select(
        *part,
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_v_{n}") for n in columns],
        *[F.sum(f"_s_{n}").over(key).alias(f"_w_{n}") for n in columns],
        F.lit(False).alias("_own"),
    )
    both = ranged.withColumn("_own", F.lit(True)).unionByName(before, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*part).orderBy("_own", way(order), F.col(tie)).rowsBetween(Window.unboundedPreceding, 0)
    )
    added = [F.sum(f"_v_{n}").over(upto).alias(n) for n in columns]
    if whole:
        added += [F.max(f"_w_{n}").over(upto).alias(f"{n}_whole") for n in columns]
    rest = [c for c in df.columns if c not in columns]
    return both.select(*rest, *added, "_own").where("_own").drop("_own")


def numbered(df: DataFrame, keys: Sequence[str], order: str, tie: str, out: str, descending: bool = False) -> DataFrame:
    """``row_number`` per key, with no oversized key confined to one task."""
    ranked = running_totals(df, keys, order, tie, {out: F.lit(1)}, descending=descending)
    return ranked.withColumn(out, F.col(out).cast("int"))


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``, which has one row per key; a null key matches a null key."""
    there = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(there, same, how).drop(*[f"_k_{k}" for k in keys])


def _near_counts(rows: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], margin: float, space: Workspace) -> DataFrame:
    """``(keys, value, _gap, _n)``: counts of the values near the wanted ranks, and of all others together.

    A sketch per key brackets each rank by two values. A value inside a bracket
    is counted as itself; those of a gap count as one row (``_gap`` 1) under the
    upper end of the bracket before it, null before the first. So rows sorted by
    value and ``_gap`` are sorted by rank, and only the brackets' values stay
    apart. Counts combine before the shuffle, and the sketches are written
    first: Spark sees their size and broadcasts them only where they are small.
    """
    ends = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketch = F.percentile_approx(value, F.array(*[F.lit(float(p)) for p in ends]), F.lit(ACCURACY)).alias("_ends")
    if keys:
        placed = matched(rows, space.keep(rows.groupBy(*keys).agg(sketch), "brackets"), keys)
    else:
        placed = rows.withColumn("_ends", rows.agg(sketch).scalar())
    v, k = F.col(value), len(probs)
    inside = reduce(lambda a, b: a | b, [v.between(F.get("_ends", F.lit(i)), F.get("_ends", F.lit(k + i))) for i in range(k)])
    passed = [F.when(v > F.get("_ends", F.lit(k + i)), F.get("_ends", F.lit(k + i))) for i in range(k)]
    before = F.greatest(*passed) if k > 1 else passed[0]
    coarse = placed.select(*keys, F.when(inside, v).otherwise(before).alias(value), F.when(inside, 0).otherwise(1).alias("_gap"))
    return coarse.groupBy(*keys, value, "_gap").agg(F.count("*").alias("_n"))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated percentiles per key, one column per name in ``probs``, as a written table; nulls do not count.

    Two scans: a sketch per key brackets the wanted ranks, then the values inside
    the brackets are counted (:func:`_near_counts`), so of a continuous column
    some thousandths of the rows move. The counts are accumulated by value,
    and each wanted rank picks its value: in a window per key where no key has
    more than ``WINDOW_ROWS`` counted values, else in ranges. A rank that falls into a gap shows that its bracket missed it: then all is done again
    with wider brackets, in the end with every value in one.
    """
    space = Workspace(df.sparkSession)
    rows = df.select(*keys, value).where(F.col(value).isNotNull())
    margin = MARGIN
    while True:
        counts = space.keep(_near_counts(rows, keys, value, list(probs.values()), margin, space), "value-counts")
        most = counts.groupBy(*keys).agg(F.count("*").alias("rows")).agg(F.max("rows")).first()[0] or 0
        found = space.keep(_picked(counts, keys, value, probs, most <= WINDOW_ROWS), "percentiles")
        if margin >= 1 or found.where("_missed").isEmpty():
            return found.drop("_missed")
        margin *= 8


def _picked(counts: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], few: bool) -> DataFrame:
    """Percentiles from :func:`_near_counts`, and whether a rank fell into a gap; ``few`` counts per key take a plain window."""
    if few:
        key = Window.partitionBy(*keys)
        upto = key.orderBy(value, "_gap").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.withColumns({"_upto": F.sum("_n").over(upto), "_upto_whole": F.sum("_n").over(key)})
    else:
        ranked = running_totals(counts, keys, value, "_gap", {"_upto": "_n"}, whole=True)
    picks, finals, misses = [], [], []
    for name, p in probs.items():
        place = F.lit(float(p)) * (F.col("_upto_whole") - 1)
        for end, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"_{end}_{name}"))
            misses.append(hit & (F.col("_gap") == 1))
        picks.append(F.max(place - F.floor(place)).alias(f"_w_{name}"))
        finals.append(
            (F.col(f"_lo_{name}") + F.col(f"_w_{name}") * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name)
        )
    picks.append(F.max(reduce(lambda a, b: a | b, misses)).alias("_missed"))
    grouped = ranked.groupBy(*keys).agg(*picks) if keys else ranked.agg(*picks)
    return grouped.select(*keys, *finals, F.coalesce("_missed", F.lit(False)).alias("_missed"))
