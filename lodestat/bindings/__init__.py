"""Operators bound to the driver tables, each with its SQL counterpart."""

from lodestat.bindings import cleaning, drift, evaluation, features, learning, profiles, runs, sources, validation
from lodestat.bindings.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "cleaning", "drift", "evaluation", "features", "learning", "profiles", "runs",
    "sources", "validation",
]
