"""Row rules with a policy each, and counts of what passed.

A rule that evaluates to null counts as failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    policy: str = WARN

    def __post_init__(self):
        if self.policy not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown policy {self.policy!r}")

    @property
    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows after the policies: warned rows stay, dropped rows go.

    A row against a ``fail`` rule raises while the result is computed, which
    aborts the write it was meant for before anything is committed.
    """
    for rule in rules:
        if rule.policy == DROP:
            df = df.where(rule.passed)
        elif rule.policy == FAIL:
            broken = F.raise_error(F.lit(f"expectation {rule.name} failed: {rule.condition}")).cast("boolean")
            df = df.where(F.when(rule.passed, F.lit(True)).otherwise(broken))
    return df


def measure(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """``(dataset, name, policy, passed_records, failed_records)`` per rule, in one pass.

    An aggregate rather than observed metrics: those may count a task twice
    when an executor is lost and its stage runs again.
    """
    counted = df.agg(*[F.count_if(r.passed).alias(f"p{i}") for i, r in enumerate(rules)], F.count("*").alias("n"))
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("name"),
            F.lit(r.policy).alias("policy"),
            F.col(f"p{i}").alias("passed_records"),
            (F.col("n") - F.col(f"p{i}")).alias("failed_records"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def enforce_and_measure(df: DataFrame, dataset: str, rules: Sequence[Rule], space) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`enforce` and the counts of :func:`measure` from one pass over ``df``.

    Every rule is evaluated once per row; the rows with their outcomes are
    written to ``space``, and both results are read from there. A row against
    a ``fail`` rule aborts that write.
    """
    tagged = enforce(df, [r for r in rules if r.policy == FAIL]).withColumn("_passed", F.array(*[r.passed for r in rules]))
    kept = space.keep(tagged, "rules")
    clean = kept
    for i, rule in enumerate(rules):
        if rule.policy == DROP:
            clean = clean.where(F.col("_passed")[i])
    outcomes = [Rule(r.name, f"_passed[{i}]", r.policy) for i, r in enumerate(rules)]
    return clean.drop("_passed"), measure(kept, dataset, outcomes)
