"""Audit log of loads, and the table of rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AUDIT_TABLE = "etl_audit"
REJECTED_TABLE = "rejected_rows"
AUDIT_COLUMNS = {
    "batch_id": "string",
    "process": "string",
    "source": "string",
    "target": "string",
    "row_count": "bigint",
    "status": "string",
    "error": "string",
    "started_at": "timestamp_ntz",
    "finished_at": "timestamp_ntz",
}


@dataclass(frozen=True)
class AuditLine:
    """One line of the log."""

    batch_id: str
    process: str
    source: str
    target: str
    row_count: int
    status: str
    error: str | None
    started_at: datetime
    finished_at: datetime | None = None


def audit_rows(spark: SparkSession, lines: Sequence[AuditLine]) -> DataFrame:
    """All lines of a load as one frame, however many files it was about."""
    schema = ", ".join(f"{name} {kind}" for name, kind in AUDIT_COLUMNS.items())
    return spark.createDataFrame([astuple(line) for line in lines], schema)
