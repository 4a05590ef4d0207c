"""Every query key with its Spark plan and, where SQL can state it, its check."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(key: str, check: str | None = None):
    """Register a plan ``f(tables) -> DataFrame`` under ``key``.

    ``check`` is the same result in DuckDB SQL over the same tables.
    """

    def register(plan: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @wraps(plan)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(spark, folder))

        QUERIES[key] = run
        if check is not None:
            CHECKS[key] = check
        return plan

    return register


def checked(key: str, check: str, flags):
    """Register a plan's numbers under ``key`` and, under ``<key>_check``, what SQL can state of them."""

    def register(plan):
        query(key)(plan)

        def check_of(t):
            return flags(plan(t))

        query(f"{key}_check", check)(check_of)
        return plan

    return register
