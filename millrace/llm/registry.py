"""Queries of the corpus operators and, where SQL can state them, their checks."""

from __future__ import annotations

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(key: str, check: str | None = None):
    def register(plan):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = plan
        if check is not None:
            CHECKS[key] = check
        return plan

    return register
