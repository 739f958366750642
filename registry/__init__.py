"""Registered queries: every operator on the given tables, with the same query in plain SQL."""

from registry.base import ORACLES, QUERIES
from registry import (  # noqa: F401  (importing registers)
    aggregates,
    events_windows,
    imputing,
    joining,
    reshaping,
    rules_outcomes,
    scalars,
    studies,
)

__all__ = ["ORACLES", "QUERIES"]
