"""The registry, and the assembling of oracle queries from named parts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapmart.testviews import DUCKDB_VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# Named parts of the oracle queries, in an order in which each uses earlier ones only.
PARTS: dict[str, str] = dict(DUCKDB_VIEWS)


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def _assemble(sql: str) -> str:
    """Put the parts that ``sql`` uses, directly or through others, before it."""
    needed: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in words & PARTS.keys() - needed:
            needed.add(name)
            open_texts.append(PARTS[name])
    parts = [f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        ORACLE_SQL[name] = _assemble(sql)
        return run

    return add
