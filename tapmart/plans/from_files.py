"""Star schema from flat trip rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.operators import dimensions as dims
from tapmart.operators.facts import DROP_REQUIRED_FILL_OPTIONAL, KEEP_UNKNOWN, build_fact
from tapmart.operators.lookups import MissPolicy
from tapmart.operators.trips import clean_file_rows, derive_file_trips
from tapmart.session import freeze, side_by_side

ALL_DIMENSIONS = ("date", "stop", "route", "rider", "fleet")


def stage_trips(
    rows: DataFrame,
    arrival: Sequence[str],
    half_even: bool = True,
    file_column: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Cleaned and derived trips as a table of their own.

    Five dimensions and the fact read it, each only the columns it needs. Written once, it
    spares them the deduplication shuffle, which is the dearest step of the load. With
    ``file_column`` there is one row per trip and file.
    """
    trips = derive_file_trips(clean_file_rows(rows, arrival, file_column), half_even)
    return freeze(trips, "trips", folder)


def observed_members(
    trips: DataFrame,
    arrival: Sequence[str],
    name: str,
    reference_year: int = presets.REFERENCE_YEAR,
    file_column: str | None = None,
) -> DataFrame:
    """The members of one dimension that occur in the trips, without keys."""
    members = {
        "date": lambda: dims.date_members(trips),
        "stop": lambda: dims.stop_members(trips, arrival, file_column),
        "route": lambda: dims.route_members(trips, arrival),
        "rider": lambda: dims.rider_members(trips, arrival, reference_year, file_column),
        "fleet": lambda: dims.fleet_members(trips, arrival),
    }
    return members[name]()


def observed_dimensions(
    trips: DataFrame,
    arrival: Sequence[str],
    load_date: Column,
    reference_year: int = presets.REFERENCE_YEAR,
    names: Sequence[str] = ALL_DIMENSIONS,
    unknown: bool = False,
) -> dict[str, DataFrame]:
    """The dimensions whose members occur in the trips.

    With ``unknown`` they have their unknown member, which also stands for rows that carry its
    natural key.
    """

    def build(name: str) -> DataFrame:
        members = observed_members(trips, arrival, name, reference_year)
        if not unknown:
            return dims.keyed_dimension(members, name, load_date)
        named = dims.without_unknown(members, name)
        return dims.add_unknown(dims.keyed_dimension(named, name, load_date), name)

    return side_by_side(trips.sparkSession, {name: partial(build, name) for name in names})


def star_from_files(
    rows: DataFrame,
    arrival: Sequence[str],
    load_date: Column,
    source: str,
    batch_id: str,
    policy: Mapping[str, MissPolicy] = KEEP_UNKNOWN,
    half_even: bool = False,
    names: Sequence[str] = ALL_DIMENSIONS,
    unknown: bool = True,
) -> dict[str, DataFrame]:
    """The dimensions asked for, and the fact under ``"fact"``.

    Only what is asked for is built: the fact's keys to other dimensions are unknown.
    """
    trips = stage_trips(rows, arrival, half_even)
    star = observed_dimensions(trips, arrival, load_date, names=names, unknown=unknown)
    return {**star, "fact": build_fact(trips, star, policy, source, batch_id)}


def strict_star_from_files(
    rows: DataFrame, arrival: Sequence[str], load_date: Column, source: str, batch_id: str
) -> dict[str, DataFrame]:
    """FB-C: required keys drop their misses, optional ones become unknown; no unknown members.

    Minutes are rounded half to even here.
    """
    return star_from_files(
        rows,
        arrival,
        load_date,
        source,
        batch_id,
        policy=DROP_REQUIRED_FILL_OPTIONAL,
        half_even=True,
        unknown=False,
    )


def load_date_column(day: str) -> Column:
    return F.lit(day).cast("date")
