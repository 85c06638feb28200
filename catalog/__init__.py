"""Registered queries: each Spark query next to the SQL that checks it."""

from catalog.base import ORACLES, QUERIES

from catalog import (  # noqa: F401  (registration by import)
    reports, models, network, risk, cleaning, landing, feeds,
)

__all__ = ["QUERIES", "ORACLES"]
