"""Incremental load of trip files into a stored star schema.

Running a load again, after a crash or by mistake, adds nothing: stored members and stored trips
are left out by their natural keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.operators import dimensions as dims
from tapmart.operators.dedup import first
from tapmart.operators.loading import resync_fact, skip_existing
from tapmart.operators.reporting import observed, observed_rows, observed_value
from tapmart.operators.trips import (
    BAD_RECORD,
    REJECT_REASONS,
    derive_file_trips,
    incomplete_reason,
    judged_file_rows,
)
from tapmart.plans.from_files import ALL_DIMENSIONS, observed_members
from tapmart.sinks.audit import AUDIT_TABLE, REJECTED_TABLE, AuditLine, audit_rows
from tapmart.sinks.warehouse import DIMENSIONS, FACT, Warehouse
from tapmart.session import freeze, side_by_side
from tapmart.sources import files

PROCESS = "file_ingest"


@dataclass
class LoadResult:
    """Rows added per table, what became of the rows read, and the files left out with the reason.

    ``rows`` counts the trip rows: ``read`` is the sum of the others, which are ``added``,
    ``duplicate``, ``skipped`` (stored before), ``look_up_missed``, and one count per reason in
    ``REJECT_REASONS``.
    """

    batch_id: str
    added: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def seed_warehouse(warehouse: Warehouse) -> None:
    """K5: create the dimensions that do not exist yet, with their unknown members."""
    spark = warehouse.spark
    seeds = {
        name: dims.unknown_row(spark, name, dims.dimension_schema(name)) for name in ALL_DIMENSIONS
    }
    name = "feedback_category"
    seeds[name] = dims.with_unknown(dims.dim_feedback_category(spark), name)
    absent = {n: rows for n, rows in seeds.items() if not warehouse.exists(f"dim_{n}")}
    work = {n: partial(warehouse.append, rows, f"dim_{n}") for n, rows in absent.items()}
    side_by_side(spark, work)


def load_rows(
    warehouse: Warehouse,
    rows: DataFrame,
    batch_id: str,
    load_date: Column,
    arrival: Sequence[str],
    source: str | Column,
    file_column: str | None = None,
    reference_year: int = presets.REFERENCE_YEAR,
    time_formats: Sequence[str] = presets.TIME_FORMATS,
) -> LoadResult:
    """Clean and stage the rows, add new members, then add the facts of new trips.

    Every file counts as cleaned on its own and in name order: the first file that has a trip, or
    a member, decides. Fact keys come from the stored dimensions after they took the new members.
    Rows that are no trip stop nothing: they go to the table of rejected rows with a reason, and
    every row read is counted once in the result.
    """
    warehouse = warehouse.snapshot()
    seed_warehouse(warehouse)
    index, sums = warehouse.trip_index(), warehouse.daily_sums()
    if warehouse.exists(FACT) and not (index.is_sound() and sums.exist()):
        index.open()
        sums.rebuild(warehouse.dimension("rider"))
        index.rebuild()
    result = LoadResult(batch_id)
    marked = rows.withColumn("_early", incomplete_reason(rows))
    reasons = {f"n{i}": F.count_if(F.col("_early") == r) for i, r in enumerate(REJECT_REASONS)}
    counted, reading = observed(marked, "rows_read", **reasons)
    judged = freeze(
        derive_file_trips(judged_file_rows(counted, arrival, file_column, time_formats), True),
        "trips",
    )
    early = {r: observed_value(reading, f"n{i}") for i, r in enumerate(REJECT_REASONS)}
    late = {r["reject_reason"]: r["count"] for r in judged.groupBy("reject_reason").count().collect()}
    staged = judged.where("reject_reason IS NULL").drop("reject_reason")
    by_reason = {r: early[r] + late.get(r, 0) for r in REJECT_REASONS}
    if any(by_reason.values()):
        _write_rejected(warehouse, marked, judged, arrival, batch_id, any(early.values()))

    def add_members(name: str) -> int:
        members = observed_members(staged, arrival, name, reference_year, file_column)
        fresh = dims.added_members(members, warehouse.dimension(name), name, load_date)
        counted, observation = observed(fresh, f"dim_{name}")
        warehouse.append(counted, f"dim_{name}")
        return observed_rows(observation)

    work = {f"dim_{name}": partial(add_members, name) for name in ALL_DIMENSIONS}
    added = side_by_side(warehouse.spark, work)

    # Stored trips go first: by id, so it makes no difference which row of a trip counts.
    trips = staged
    if warehouse.exists(FACT):
        trips = skip_existing(staged, index.stored_ids(staged, late.get(None, 0)))
    trips, fresh = observed(trips, "rows_not_stored")
    trips = first(trips, "trip_id", arrival) if file_column else trips
    trips, unique = observed(trips, "trips_not_stored")
    stored = {name: warehouse.dimension(name) for name in DIMENSIONS}
    loaded_at = F.current_timestamp().cast("timestamp_ntz")
    fact = resync_fact(trips, stored, source, batch_id, loaded_at)
    facts = _add_facts(warehouse, fact, staged, batch_id)
    result.added = {**added, FACT: facts}
    read, good = observed_rows(reading), late.get(None, 0)
    result.rows = {
        "read": read,
        "added": facts,
        "duplicate": read - sum(early.values()) - sum(late.values())
        + observed_rows(fresh) - observed_rows(unique),
        "skipped": good - observed_rows(fresh),
        "look_up_missed": observed_rows(unique) - facts,
        **by_reason,
    }
    return result


def _add_facts(warehouse: Warehouse, fact: DataFrame, staged: DataFrame, batch_id: str) -> int:
    """Write facts, add to the sums per day and put their ids into the index; the number of facts.

    They are read back from the dates of the batch, from files of this batch alone: a load
    writes files of its own, and the statistics of others rule them out.
    """
    index, sums = warehouse.trip_index(), warehouse.daily_sums()
    riders = warehouse.dimension("rider")
    known = warehouse.exists(FACT)
    index.open()
    facts = observed_rows(warehouse.write_fact(fact))
    if not known:
        if facts:
            sums.rebuild(riders)
            index.rebuild()
        return facts
    dates = staged.select("travel_date").distinct()
    own = warehouse.read(FACT).where(F.col("batch_id") == batch_id)
    own = own.join(dates, "travel_date", "left_semi")
    if facts:
        sums.add(own, riders)
    index.add(own, facts)
    return facts


def _write_rejected(
    warehouse: Warehouse,
    marked: DataFrame,
    judged: DataFrame,
    arrival: Sequence[str],
    batch_id: str,
    any_early: bool,
) -> None:
    """The rows that are no trip: where they stand, the trip, the reason, and the record where
    it could not be read."""

    def laid_out(rows: DataFrame, trip: str, reason: str, record: Column) -> DataFrame:
        return rows.where(F.col(reason).isNotNull()).select(
            F.lit(batch_id).alias("batch_id"),
            F.to_json(F.struct(*arrival)).alias("arrival"),
            F.col(trip).cast("string").alias("trip_id"),
            F.col(reason).alias("reason"),
            record.cast("string").alias("record"),
        )

    rejected = laid_out(judged, "trip_id", "reject_reason", F.lit(None))
    if any_early:
        record = F.col(BAD_RECORD) if BAD_RECORD in marked.columns else F.lit(None)
        rejected = rejected.unionByName(laid_out(marked, "transID", "_early", record))
    warehouse.append(rejected, REJECTED_TABLE)


def load_files(
    warehouse: Warehouse,
    paths: Sequence[str],
    batch_id: str,
    load_date: Column,
    reference_year: int = presets.REFERENCE_YEAR,
    multi_line: bool = False,
    time_formats: Sequence[str] = presets.TIME_FORMATS,
    begun: Mapping[str, int] | None = None,
) -> LoadResult:
    """Check the files, load the good ones together, log good and bad ones.

    The log has a line per file that could not be read, per table that took rows, and per count of
    trip rows. With ``begun``, the highest key per dimension table when the batch was begun first,
    counts are those of the whole batch, whichever run stored what, and lines that a run before
    this one has logged are not logged again.
    """
    spark = warehouse.spark
    started = _now()
    checks = files.check_files(spark, sorted(paths))
    rejected = {c.path: c.problem for c in checks if c.problem}
    good = [c for c in checks if not c.problem]
    result = LoadResult(batch_id)
    lines: list[AuditLine] = []

    def log(source: str, target: str, count: int, status: str, error: str | None = None) -> None:
        lines.append(
            AuditLine(batch_id, PROCESS, source, target, count, status, error, started, _now())
        )

    for path, problem in rejected.items():
        log(path, FACT, 0, presets.AUDIT_FAILED, problem)
    together = f"{len(good)} files"
    try:
        if good:
            result = load_rows(
                warehouse,
                files.read_checked(spark, good, multi_line),
                batch_id,
                load_date,
                files.ARRIVAL,
                files.source_tag(F.col("source_file")),
                file_column="source_file",
                reference_year=reference_year,
                time_formats=time_formats,
            )
            if begun is not None:
                _count_all_runs(warehouse, result, begun)
    except Exception as error:
        log(together, FACT, 0, presets.AUDIT_FAILED, str(error))
        raise
    else:
        lost = [r for r in REJECT_REASONS if result.rows.get(r)]
        lost += ["look_up_missed"] if result.rows.get("look_up_missed") else []
        partial_load = good and (rejected or lost)
        status = presets.AUDIT_PARTIAL if partial_load else presets.AUDIT_OK
        for table, count in result.added.items():
            log(together, table, count, status)
        for name, count in result.rows.items():
            log(together, f"{FACT}: {name}", count, status)
    finally:
        told = audit_rows(spark, lines)
        if lines and begun is not None and warehouse.exists(AUDIT_TABLE):
            known = warehouse.read(AUDIT_TABLE).where(F.col("batch_id") == batch_id)
            told = told.join(known, ["source", "target", "status"], "left_anti").select(told.columns)
        if lines:
            warehouse.append(told.coalesce(1), AUDIT_TABLE)
    result.rejected = rejected
    return result


def _count_all_runs(warehouse: Warehouse, result: LoadResult, begun: Mapping[str, int]) -> None:
    """Count what the batch has added since it was begun, not only in this run."""
    for name in ALL_DIMENSIONS:
        above = F.col(f"{name}_key") > begun.get(f"dim_{name}", 0)
        result.added[f"dim_{name}"] = warehouse.dimension(name).where(above).count()
    own = F.col("batch_id") == result.batch_id
    facts = warehouse.read(FACT).where(own).count() if warehouse.exists(FACT) else 0
    result.rows["skipped"] -= facts - result.rows["added"]
    result.rows["added"] = result.added[FACT] = facts


def load_folder(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    batch_id: str,
    load_date: Column,
    reference_year: int = presets.REFERENCE_YEAR,
    multi_line: bool = False,
    time_formats: Sequence[str] = presets.TIME_FORMATS,
) -> LoadResult:
    """Load all files of a folder in one batch."""
    paths = files.list_files(spark, folder)
    if not paths:
        return LoadResult(batch_id)
    return load_files(warehouse, paths, batch_id, load_date, reference_year, multi_line, time_formats)
