"""Dimension builders and unknown members."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapmart import presets
from tapmart.functions import riders, routes
from tapmart.functions.calendar import calendar_attributes
from tapmart.operators.cleaning import trim_columns, with_validity
from tapmart.operators.dedup import distinct_values, first_version
from tapmart.operators.keys import append_keys, dense_key


def literal_rows(
    spark: SparkSession, rows: Iterable[Sequence[object]], columns: Mapping[str, str]
) -> DataFrame:
    """A small fixed table (S8, S9, X1), made in the JVM."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, columns.items())])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


# ------------------------------------------------------------------------------------ calendar
def date_spine(bounds: DataFrame, first: str = "first_date", last: str = "last_date") -> DataFrame:
    """One row per day from the first to the last date; ``bounds`` has one row."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date"))


def fixed_bounds(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first_date"), F.lit(last).cast("date").alias("last_date")
    )


def date_members(trips: DataFrame) -> DataFrame:
    """U4: the days on which there was a trip."""
    return distinct_values(trips, "travel_date").toDF("date").dropna()


# --------------------------------------------------------------------------------------- stops
def table_stops(stop_table: DataFrame) -> DataFrame:
    """DM3: stops of a stop table."""
    return trim_columns(stop_table, ["stop_name"])


def stop_members(
    trips: DataFrame, arrival: Sequence[str], file_column: str | None = None
) -> DataFrame:
    """DM4, X2: every stop seen, boarding rows before alighting rows, then by arrival.

    Both roles come out of one pass over the trips.
    """
    roles = [
        F.struct(
            F.lit(priority).alias("_role"),
            F.col(f"{role}_stop_id").alias("stop_id"),
            F.col(f"{role}_stop_name").alias("stop_name"),
            F.col(f"{role}_lat").alias("latitude"),
            F.col(f"{role}_lon").alias("longitude"),
        )
        for priority, role in enumerate(("board", "alight"))
    ]
    seen = trips.select(F.inline(F.array(*roles)), *arrival).dropna(subset=["stop_id"])
    attributes = ["_role", "stop_name", "latitude", "longitude"]
    by_role = [F.col("_role")]
    return first_version(seen, "stop_id", attributes, arrival, by_role, file_column).drop("_role")


# -------------------------------------------------------------------------------------- routes
def table_routes(route_table: DataFrame) -> DataFrame:
    """DM5: routes of a route table; the type is derived, whatever the table says."""
    return route_table.withColumns(
        {
            "corridor_type": routes.corridor_type(F.col("route_id")),
            "origin": routes.origin(F.col("route_name")),
            "destination": routes.destination(F.col("route_name")),
            "route_name": F.trim("route_name"),
        }
    )


def route_members(trips: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """DM5: every route seen, with the name it had first."""
    return first_version(trips, "route_id", ["route_name"], arrival).withColumns(
        {
            "corridor_type": routes.corridor_type_or_other(F.col("route_id")),
            "origin": routes.origin_first_split(F.col("route_name")),
            "destination": routes.destination_first_split(F.col("route_name")),
        }
    )


# -------------------------------------------------------------------------------------- riders
def with_age(
    people: DataFrame,
    reference_year: int,
    age_bands: presets.Bands = presets.AGE_BANDS_NULL_AWARE,
    segments: presets.Bands = presets.SEGMENTS_NULL_AWARE,
) -> DataFrame:
    """D9-D11."""
    aged = people.withColumn("age", riders.age(F.col("birth_year"), reference_year))
    return aged.withColumns(
        {
            "age_band": riders.age_band(F.col("age"), age_bands),
            "rider_segment": riders.segment(F.col("age"), segments),
        }
    )


def rider_members(
    trips: DataFrame,
    arrival: Sequence[str],
    reference_year: int,
    file_column: str | None = None,
) -> DataFrame:
    """DM6, U3: every card seen, as described where its birth year is known and smallest."""
    attributes = ["rider_name", "card_bank", "gender", "birth_year"]
    by_birth = [F.col("birth_year").asc_nulls_last()]
    cards = trips.dropna(subset=["rider_id"])
    versions = first_version(cards, "rider_id", attributes, arrival, by_birth, file_column)
    return with_age(versions, reference_year)


# --------------------------------------------------------------------------------------- fleet
def with_vehicle(df: DataFrame, corridor_type: str = "corridor_type") -> DataFrame:
    """Vehicle type and capacity of a corridor type; unlisted types count as other."""
    table = literal_rows(
        df.sparkSession,
        presets.VEHICLES,
        {"_type": "string", "_vehicle": "string", "_capacity": "smallint"},
    )
    other = next(row for row in presets.VEHICLES if row[0] == presets.CORRIDOR_TYPE_OTHER)
    joined = df.join(F.broadcast(table), F.col(corridor_type) == F.col("_type"), "left")
    return joined.withColumns(
        {
            "vehicle_type": F.coalesce("_vehicle", F.lit(other[1])),
            "capacity": F.coalesce("_capacity", F.lit(other[2]).cast("smallint")),
        }
    ).drop("_type", "_vehicle", "_capacity")


def fleet_members(trips: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """DM7: one row per synthetic vehicle."""
    attributes = ["route_id", "direction", "travel_date"]
    seen = first_version(trips, "fleet_id", attributes, arrival)
    typed = seen.withColumn("corridor_type", routes.corridor_type_or_other(F.col("route_id")))
    return (
        with_vehicle(typed)
        .withColumnRenamed("travel_date", "operating_date")
        .withColumns({"is_synthetic": F.lit(1), "note": F.lit(presets.FLEET_NOTE)})
        .drop("corridor_type")
    )


def fleet_load_summary(trips: DataFrame) -> DataFrame:
    """Vehicles, trips and trips per vehicle."""
    per_vehicle = trips.groupBy("fleet_id").agg(F.count(F.lit(1)).alias("trips"))
    return per_vehicle.agg(
        F.count("fleet_id").alias("vehicles"), F.sum("trips").alias("trips")
    ).withColumn("trips_per_vehicle", F.round(F.try_divide("trips", "vehicles"), 1))


# ------------------------------------------------------------------------- feedback categories
def dim_feedback_category(spark: SparkSession) -> DataFrame:
    """DM8, S8, X1."""
    return literal_rows(
        spark,
        presets.FEEDBACK_CATEGORIES,
        {"feedback_category_key": "int", "category_name": "string", "description": "string"},
    )


# -------------------------------------------------------------------------------- keyed members
NATURAL_KEYS = {
    "date": "date",
    "stop": "stop_id",
    "route": "route_id",
    "rider": "rider_id",
    "fleet": "fleet_id",
    "feedback_category": "category_name",
}
# Members of these have a small fixed limit: the date type itself has 3.7 million values.
BOUNDED = ("date",)
_VALIDITY = ("valid_from", "valid_to", "is_current")
# The column layouts of the target tables.
LAYOUTS = {
    "date": (
        "date_key",
        "date",
        "year",
        "quarter",
        "month",
        "month_name",
        "week_of_year",
        "day_of_month",
        "day_of_week",
        "day_name",
        "is_weekend",
        "is_holiday",
        "holiday_note",
    ),
    "stop": ("stop_key", "stop_id", "stop_name", "latitude", "longitude", *_VALIDITY),
    "route": (
        "route_key",
        "route_id",
        "route_name",
        "origin",
        "destination",
        "corridor_type",
        *_VALIDITY,
    ),
    "rider": (
        "rider_key",
        "rider_id",
        "rider_name",
        "card_bank",
        "gender",
        "birth_year",
        "age",
        "age_band",
        "rider_segment",
        *_VALIDITY,
    ),
    "fleet": (
        "fleet_key",
        "fleet_id",
        "route_id",
        "direction",
        "operating_date",
        "vehicle_type",
        "capacity",
        "is_synthetic",
        "note",
    ),
    "feedback_category": ("feedback_category_key", "category_name", "description"),
}


_TYPES = {
    "date_key": "int",
    "date": "date",
    "year": "smallint",
    "quarter": "tinyint",
    "month": "tinyint",
    "week_of_year": "tinyint",
    "day_of_month": "tinyint",
    "day_of_week": "tinyint",
    "is_weekend": "int",
    "is_holiday": "int",
    "stop_key": "bigint",
    "route_key": "bigint",
    "rider_key": "bigint",
    "fleet_key": "bigint",
    "feedback_category_key": "int",
    "latitude": "decimal(10,7)",
    "longitude": "decimal(10,7)",
    "rider_id": "bigint",
    "birth_year": "int",
    "age": "int",
    "direction": "smallint",
    "operating_date": "date",
    "capacity": "smallint",
    "is_synthetic": "int",
    "valid_from": "date",
    "valid_to": "date",
    "is_current": "int",
}


def dimension_schema(name: str) -> T.StructType:
    """Columns and types of a dimension; columns without an entry are texts."""
    fields = [f"`{column}` {_TYPES.get(column, 'string')}" for column in LAYOUTS[name]]
    return T.StructType.fromDDL(", ".join(fields))


def _lay_out(keyed: DataFrame, name: str, load_date: Column | None) -> DataFrame:
    """P17, D14, D18."""
    if name == "date":
        keyed = keyed.withColumns(calendar_attributes(F.col("date")))
    if "valid_from" in LAYOUTS[name]:
        keyed = with_validity(keyed, load_date)
    return keyed.select(*LAYOUTS[name])


def keyed_dimension(members: DataFrame, name: str, load_date: Column | None = None) -> DataFrame:
    """DM1-DM7: the members in the layout of their dimension, keyed in natural key order."""
    keyed = dense_key(members, f"{name}_key", [NATURAL_KEYS[name]], bounded=name in BOUNDED)
    return _lay_out(keyed, name, load_date)


def added_members(
    members: DataFrame, stored: DataFrame, name: str, load_date: Column | None = None
) -> DataFrame:
    """K6: the members that the stored dimension lacks, with the keys that follow its own."""
    key, natural_key = f"{name}_key", NATURAL_KEYS[name]
    keyed = append_keys(members, stored, key, natural_key, bounded=name in BOUNDED)
    return _lay_out(keyed, name, load_date)


# ----------------------------------------------------------------------------- unknown members
def without_unknown(members: DataFrame, name: str) -> DataFrame:
    """Members other than the unknown one.

    Rows that carry the unknown member's natural key (a route id ``UNKNOWN``) stand for it, so
    must not become a second member with that key: a look-up would find both.
    """
    natural_key = NATURAL_KEYS[name]
    return members.where(F.col(natural_key) != F.lit(presets.UNKNOWN_ROWS[name][natural_key]))


def unknown_row(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The unknown member in the layout of its dimension; attributes not listed are null."""
    values = presets.UNKNOWN_ROWS[name]
    return spark.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def add_unknown(dimension: DataFrame, name: str) -> DataFrame:
    """Add the unknown member to a dimension that was just keyed, so does not have it."""
    row = unknown_row(dimension.sparkSession, name, dimension.schema)
    return dimension.unionByName(row)


def with_unknown(dimension: DataFrame, name: str) -> DataFrame:
    """K5: add the unknown member unless the dimension has it."""
    row = unknown_row(dimension.sparkSession, name, dimension.schema)
    is_unknown = F.col(f"{name}_key") == presets.UNKNOWN_KEY
    stored = dimension.agg(F.count_if(is_unknown).alias("stored")).scalar()
    return dimension.unionByName(row.where(stored == 0))
