"""Star schema from relational source tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.operators import dimensions as dims
from tapmart.operators.dedup import latest
from tapmart.operators.facts import (
    DROP_REQUIRED,
    FACT_STRICT_COLUMNS,
    KEEP_UNKNOWN,
    build_fact,
    feedback_with_category,
)
from tapmart.operators.trips import clean_table_trips, with_status, with_trip_times
from tapmart.session import side_by_side
from tapmart.sinks.audit import AUDIT_TABLE, AuditLine, audit_rows
from tapmart.sinks.warehouse import FACT, Warehouse
from tapmart.sources.tables import extract


def table_dimensions(
    tables: Mapping[str, DataFrame],
    days: DataFrame,
    load_date: Column,
    reference_year: int,
    age_bands: presets.Bands = presets.AGE_BANDS_EXCLUSIVE,
    segments: presets.Bands = presets.SEGMENTS_EXCLUSIVE,
) -> dict[str, DataFrame]:
    """DM1, DM3, DM5, DM6, DM8 from the calendar days and the source tables."""
    members = {
        "date": days,
        "stop": dims.table_stops(tables["stops"]),
        "route": dims.table_routes(tables["routes"]),
        "rider": dims.with_age(tables["riders"], reference_year, age_bands, segments),
    }
    work = {
        name: partial(dims.keyed_dimension, frame, name, load_date)
        for name, frame in members.items()
    }
    built = side_by_side(days.sparkSession, work)
    return {**built, "feedback_category": dims.dim_feedback_category(days.sparkSession)}


def full_fact(
    tables: Mapping[str, DataFrame],
    star: Mapping[str, DataFrame],
    source: str,
    batch_id: str,
    tie_break: Sequence[str] = (),
    loaded_at: Column | None = None,
) -> DataFrame:
    """FB-A: the newest row of every trip, with stored status, feedback and unknown keys.

    A fleet dimension takes part where ``star`` has one.
    """
    feedback = feedback_with_category(tables["feedback"], star["feedback_category"], tie_break)
    trips = clean_table_trips(tables["trips"], tie_break)
    return build_fact(
        trips, star, KEEP_UNKNOWN, source, batch_id, feedback=feedback, loaded_at=loaded_at
    )


def strict_fact(
    tables: Mapping[str, DataFrame],
    star: Mapping[str, DataFrame],
    source: str,
    batch_id: str,
    tie_break: Sequence[str] = (),
    loaded_at: Column | None = None,
) -> DataFrame:
    """FB-B: only trips whose date, rider and boarding stop are known; status is derived.

    The source status filter reaches the scan of the trip table.
    """
    wanted = F.col("status").isin(presets.STATUS_SUCCESS, presets.STATUS_FREE)
    trips = with_status(with_trip_times(tables["trips"].where(wanted)))
    trips = latest(trips, "trip_id", tie_break=[F.col(name) for name in tie_break])
    return build_fact(
        trips,
        star,
        DROP_REQUIRED,
        source,
        batch_id,
        columns=FACT_STRICT_COLUMNS,
        loaded_at=loaded_at,
    )


def load_tables(
    warehouse: Warehouse,
    readers: Mapping[str, Callable[[], DataFrame | None]],
    days: DataFrame,
    load_date: Column,
    source: str,
    batch_id: str,
    strict: bool = False,
    reference_year: int = presets.REFERENCE_YEAR,
    tie_break: Sequence[str] = (),
) -> dict[str, int]:
    """A full load from source tables, end to end: rows per table.

    Extracts the sources (a dimension of vehicles that is stored already takes part), builds the
    dimensions and the fact of ``full_fact``, or with ``strict`` of ``strict_fact``, puts all in
    place at the end, and logs every table, or the failure.
    """
    started = datetime.now(timezone.utc).replace(tzinfo=None)

    def log(lines: Mapping[str, int], status: str, error: str | None = None) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = [
            AuditLine(batch_id, "table_load", source, table, count, status, error, started, now)
            for table, count in lines.items()
        ]
        warehouse.append(audit_rows(warehouse.spark, rows).coalesce(1), AUDIT_TABLE)

    try:
        tables = extract(readers)
        dimensions = table_dimensions(tables, days, load_date, reference_year)
        star = dict(dimensions)
        if warehouse.exists("dim_fleet"):
            star["fleet"] = warehouse.dimension("fleet")
        build = strict_fact if strict else full_fact
        loaded = warehouse.load_all(dimensions, build(tables, star, source, batch_id, tie_break))
    except Exception as error:
        log({FACT: 0}, presets.AUDIT_FAILED, str(error))
        raise
    log(loaded, presets.AUDIT_OK)
    return loaded
