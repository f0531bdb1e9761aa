"""Checked queries over the test tables."""

from statflow.catalog import (  # noqa: F401
    checks,
    figures,
    lookups,
    merging,
    parsing,
    queueing,
    storage,
)
from statflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
