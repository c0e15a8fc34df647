"""Registered queries: every operator on the given tables, next to its oracle in DuckDB SQL."""

from __future__ import annotations

from tapmart.queries.registry import ORACLE_SQL, QUERIES
from tapmart.queries import cleaning, derive, dimensions, facts, loads, reports  # noqa: F401

__all__ = ["ORACLE_SQL", "QUERIES"]
