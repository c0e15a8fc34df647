"""Loads into a stored star schema, end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tapmart import testviews
from tapmart.operators import olap
from tapmart.operators.facts import FACT_FULL_COLUMNS, FACT_STRICT_COLUMNS
from tapmart.operators.loading import skip_existing
from tapmart.plans.from_tables import load_tables
from tapmart.plans.incremental import load_rows
from tapmart.queries.dimensions import ARRIVAL, load_date, staged
from tapmart.queries.facts import (
    BATCH,
    SPLIT_DAY,
    TIE_BREAK,
    _stored,
    calendar_days,
    source_tables,
)
from tapmart.queries.registry import part, query
from tapmart.session import shared_folder
from tapmart.sinks.warehouse import FACT, Warehouse


def _warehouse(spark):
    return Warehouse(spark, f"{shared_folder(spark)}/tapmart/warehouse-{uuid.uuid4().hex}")


def _loaded(spark, sf_dir, strict):
    warehouse = _warehouse(spark)
    readers = {name: (lambda t=t: t) for name, t in source_tables(spark, sf_dir).items()}
    days = calendar_days(spark, sf_dir)
    load_tables(
        warehouse, readers, days, load_date(), "postgresql", BATCH, strict, tie_break=TIE_BREAK
    )
    return warehouse.read(FACT)


@query("table_load_full", "SELECT * FROM p_fact_without_fleet")
def table_load_full(spark, sf_dir):
    return _loaded(spark, sf_dir, strict=False).select(*FACT_FULL_COLUMNS)


@query("table_load_strict", "SELECT * FROM p_fact_strict")
def table_load_strict(spark, sf_dir):
    return _loaded(spark, sf_dir, strict=True).select(*FACT_STRICT_COLUMNS)


@query(
    "fact_skip_indexed",
    """SELECT trip_id, travel_date, paid, status FROM p_trips
    WHERE trip_id NOT IN (SELECT trip_id FROM p_stored)""",
)
def fact_skip_indexed(spark, sf_dir):
    """The trips that are not stored, told by the index of stored ids; the fact is not read."""
    warehouse = _warehouse(spark)
    rows = staged(spark, sf_dir)
    warehouse.write_fact(_stored(rows))
    index = warehouse.trip_index()
    index.rebuild()
    fresh = skip_existing(rows, index.stored_ids(rows, rows.count()))
    return fresh.select("trip_id", "travel_date", "paid", "status")


def _two_batches(spark, sf_dir):
    """A first batch of part of the trips, then everything."""
    warehouse = _warehouse(spark)
    taps = testviews.taps(spark, sf_dir)
    early = F.col("tapInTime") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    first = taps.where(early & F.expr("payCardID % 7 <> 3"))
    for batch, rows in (("b1", first), ("b2", taps)):
        load_rows(warehouse, rows, batch, load_date(), ARRIVAL, "csv")
    return warehouse


@query(
    "incremental_fact",
    """SELECT trip_id, paid, status, CASE WHEN trip_id IN (SELECT trip_id FROM p_stored) THEN 'b1'
      ELSE 'b2' END AS batch_id FROM p_trips""",
)
def incremental_fact(spark, sf_dir):
    """Trips are stored once, under the batch that brought them first."""
    fact = _two_batches(spark, sf_dir).read(FACT)
    return fact.select("trip_id", "paid", "status", "batch_id")


def _kept_sums(spark, sf_dir):
    """The sums after three loads, none of which has the trips of whole days."""
    warehouse = _warehouse(spark)
    taps = testviews.taps(spark, sf_dir)
    for n in (2, 0, 1):
        rows = taps.where(F.expr(f"pmod(payCardID, 3) = {n} OR payCardID IS NULL"))
        load_rows(warehouse, rows, f"b{n}", load_date(), ARRIVAL, "csv")
    return warehouse


@query(
    "kept_daily_trend",
    """SELECT travel_date AS date, count(*) AS trips, CAST(sum(paid) AS DECIMAL(20,2)) AS revenue,
    round(avg(duration_half_even), 1) AS avg_minutes FROM p_trips WHERE is_success = 1 GROUP BY travel_date""",
)
def kept_daily_trend(spark, sf_dir):
    """Q1 from the sums that loads keep; the fact is not read."""
    warehouse = _kept_sums(spark, sf_dir)
    report = olap.daily_trend(warehouse.daily_sums().trips(), warehouse.dimension("date"))
    return report.select("date", "trips", "revenue", "avg_minutes")


@query(
    "kept_rider_profile",
    """SELECT d.age_band, d.rider_segment, d.card_bank, d.gender, count(*) AS trips, true AS close
    FROM p_trips t JOIN p_dim_rider d ON t.rider_id = d.rider_id WHERE t.is_success = 1
    GROUP BY d.age_band, d.rider_segment, d.card_bank, d.gender""",
)
def kept_rider_profile(spark, sf_dir):
    """Q4 from kept sketches: whether riders are within 2 % of the exact count."""
    warehouse = _kept_sums(spark, sf_dir)
    star = warehouse.star()
    exact = olap.rider_profile(star["fact"], star["rider"]).select(
        *olap.PROFILE, F.col("riders").alias("exact")
    )
    kept = olap.rider_profile_from_sums(warehouse.daily_sums().riders())
    close = F.abs(F.col("riders") - F.col("exact")) <= 0.02 * F.col("exact")
    joined = kept.join(exact, list(olap.PROFILE), "left")
    return joined.select(*olap.PROFILE, "trips", F.coalesce(close, F.lit(False)).alias("close"))


@query(
    "incremental_rider",
    """SELECT rider_key, rider_id FROM p_stored_rider UNION ALL
    SELECT (SELECT max(rider_key) FROM p_stored_rider) + row_number() OVER (ORDER BY rider_id),
      rider_id FROM (SELECT DISTINCT rider_id FROM p_trips
      WHERE rider_id NOT IN (SELECT rider_id FROM p_stored_rider))""",
)
def incremental_rider(spark, sf_dir):
    """Keys of the second batch go on after those of the first."""
    riders = _two_batches(spark, sf_dir).dimension("rider")
    return riders.where("rider_key > 0").select("rider_key", "rider_id")


part(
    "p_complete",
    """SELECT transID FROM taps WHERE transID IS NOT NULL AND tapInTime IS NOT NULL
      AND payCardID IS NOT NULL AND tapInStops IS NOT NULL""",
)


@query(
    "load_reject_report",
    """SELECT 'read' AS step, count(*) AS rows FROM taps
    UNION ALL SELECT 'required value is missing', (SELECT count(*) FROM taps) - count(*)
      FROM p_complete
    UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT transID) FROM p_complete
    UNION ALL SELECT 'added', count(DISTINCT transID) FROM p_complete""",
)
def load_reject_report(spark, sf_dir):
    """What became of every row of a load, where it happened at all."""
    taps = testviews.taps(spark, sf_dir)
    result = load_rows(_warehouse(spark), taps, "b1", load_date(), ARRIVAL, "csv")
    counts = [(step, rows) for step, rows in result.rows.items() if rows]
    return spark.createDataFrame(counts, "step string, rows bigint")
