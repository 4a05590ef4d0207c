"""Query plans by area; importing this package fills the registry."""

from millrace.plans import models, nested, pipelines, relational, scans, series, texts, versions  # noqa: F401
from millrace.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
