"""Sums per day that every load adds to: reports are read from them and not from the fact (A4, A10)."""

from __future__ import annotations

from typing import TYPE_CHECKING, ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.operators import olap
from tapmart.operators.cleaning import ensure_columns

if TYPE_CHECKING:
    from tapmart.sinks.warehouse import Warehouse

# Registers of a sketch as a power of two: a standard error of 0.7 %, and at most 16 KB a sketch.
SKETCH_BITS = 14
_COLUMNS = {
    "date_key": "int",
    "route_key": "bigint",
    "rider_key": "bigint",
    "card_bank": "string",
    "tap_in_hour": "int",
    "day_part": "string",
    "direction": "int",
    "is_success": "int",
    "is_free": "int",
    "paid": "decimal(10,2)",
    "duration_min": "smallint",
}


class DailySums:
    """Partial sums of the stored fact, in two tables.

    ``sums_trips`` has trips, payments and minutes per day and per what the reports group by; its
    rows can stand in for the fact in the reports on days, routes and hours. ``sums_riders`` has
    trips, payments and a sketch of the riders per day and rider profile; stored members never
    change, so neither do profiles. Columns that a fact lacks count as null.

    Facts are only ever added. So a load adds the sums of its own trips, whichever days they fall
    on, as further rows, and reading adds rows of one group up. While the index of trips is marked
    as open the sums may lack the trips of a load that was stopped; they are then built anew with
    it.
    """

    TRIPS: ClassVar[str] = "sums_trips"
    RIDERS: ClassVar[str] = "sums_riders"
    TABLES: ClassVar[tuple[str, ...]] = (TRIPS, RIDERS)

    def __init__(self, warehouse: Warehouse, fact: str = "fact_trip"):
        self.warehouse, self.fact = warehouse, fact

    def exist(self) -> bool:
        return all(self.warehouse.exists(table) for table in self.TABLES)

    def rebuild(self, riders: DataFrame) -> None:
        """Add up all of the stored fact."""
        trips, profiles = self._sums(self.warehouse.read(self.fact), riders)
        self.warehouse.replace(trips, self.TRIPS)
        self.warehouse.replace(profiles, self.RIDERS)

    def add(self, fact: DataFrame, riders: DataFrame) -> None:
        """Add the sums of trips that were just stored."""
        trips, profiles = self._sums(fact, riders)
        self.warehouse.append(trips.coalesce(1), self.TRIPS)
        self.warehouse.append(profiles.coalesce(1), self.RIDERS)

    def _sums(self, fact: DataFrame, riders: DataFrame) -> tuple[DataFrame, DataFrame]:
        fact = ensure_columns(fact, {n: F.lit(None).cast(kind) for n, kind in _COLUMNS.items()})
        return olap.trip_sums(fact), olap.rider_sums(fact, riders, SKETCH_BITS)

    def trips(self) -> DataFrame:
        """Rows that the reports take in place of the fact's."""
        return self.warehouse.read(self.TRIPS)

    def riders(self) -> DataFrame:
        """Rows for ``olap.rider_profile_from_sums``, of any days."""
        return self.warehouse.read(self.RIDERS)
