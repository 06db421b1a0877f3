"""The registered queries: operators wired to the test tables.

Every query runs over the whole of its tables and carries, where SQL can say it,
the statement its result is checked against.
"""

from __future__ import annotations

from velotide.registry import star, stations, status, tables, trips, weather  # noqa: F401
from velotide.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
