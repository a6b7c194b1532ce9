"""Registered queries, one module per SURVEY §2 family."""

from quarry.plans import booking, models, profiling, quality, relational, sources, statistics, streams  # noqa: F401
from quarry.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
