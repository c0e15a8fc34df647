"""Fact table of trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions.trips import flag
from tapmart.operators.cleaning import with_lineage
from tapmart.operators.dedup import latest
from tapmart.operators.lookups import MissPolicy, look_up

# What each look-up joins on and takes: trip column, dimension, natural key, columns, bounded.
LOOKUPS = {
    "date": ("travel_date", "date", "date", {"date_key": "date_key"}, True),
    "board_stop": ("board_stop_id", "stop", "stop_id", {"stop_key": "board_stop_key"}, False),
    "alight_stop": ("alight_stop_id", "stop", "stop_id", {"stop_key": "alight_stop_key"}, False),
    "route": ("route_id", "route", "route_id", {"route_key": "route_key"}, False),
    "rider": (
        "rider_id",
        "rider",
        "rider_id",
        {"rider_key": "rider_key", "card_bank": "card_bank"},
        False,
    ),
    "fleet": ("fleet_id", "fleet", "fleet_id", {"fleet_key": "fleet_key"}, False),
}

KEEP_UNKNOWN: Mapping[str, MissPolicy] = dict.fromkeys(LOOKUPS, "unknown")
DROP_REQUIRED: Mapping[str, MissPolicy] = {
    "date": "drop",
    "board_stop": "drop",
    "alight_stop": "null",
    "route": "null",
    "rider": "drop",
    "fleet": "null",
}
DROP_REQUIRED_FILL_OPTIONAL: Mapping[str, MissPolicy] = {
    "date": "drop",
    "board_stop": "drop",
    "alight_stop": "unknown",
    "route": "unknown",
    "rider": "drop",
    "fleet": "unknown",
}

# The column layouts of the target fact tables.
FACT_FULL_COLUMNS = (
    "date_key",
    "board_stop_key",
    "alight_stop_key",
    "route_key",
    "rider_key",
    "feedback_category_key",
    "fleet_key",
    "trip_id",
    "fleet_id",
    "tap_in_at",
    "tap_out_at",
    "tap_in_hour",
    "day_part",
    "paid",
    "duration_min",
    "fare",
    "discount",
    "distance_km",
    "direction",
    "board_seq",
    "alight_seq",
    "card_bank",
    "pay_method",
    "status",
    "is_success",
    "is_free",
    "rating",
    "comment",
    "has_feedback",
    "source",
    "batch_id",
)
FACT_STRICT_COLUMNS = (
    "date_key",
    "board_stop_key",
    "alight_stop_key",
    "route_key",
    "rider_key",
    "trip_id",
    "tap_in_at",
    "tap_out_at",
    "tap_in_hour",
    "day_part",
    "paid",
    "duration_min",
    "direction",
    "board_seq",
    "alight_seq",
    "card_bank",
    "status",
    "is_success",
    "is_free",
    "source",
    "batch_id",
)

# Types of the columns a source may lack.
_OPTIONAL_COLUMNS = {
    "fleet_id": "string",
    "feedback_category_key": "int",
    "fare": "decimal(10,2)",
    "discount": "decimal(10,2)",
    "distance_km": "decimal(5,2)",
    "board_seq": "smallint",
    "alight_seq": "smallint",
    "pay_method": "string",
    "rating": "smallint",
    "comment": "string",
}


def feedback_with_category(
    feedback: DataFrame, categories: DataFrame, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest feedback per trip with the key of its category.

    One row per trip is made sure of here, so that joining it cannot multiply trips. Feedback
    without a category column gets a null key. The categories are a fixed short list.
    """
    one = latest(feedback, "trip_id", tie_break=[F.col(name) for name in tie_break])
    if "category" not in feedback.columns:
        one = one.withColumn("feedback_category_key", F.lit(None).cast("int"))
        return one.select("trip_id", "rating", "comment", "feedback_category_key")
    take = {"feedback_category_key": "feedback_category_key"}
    keyed = look_up(one, categories, ("category", "category_name"), take, "null", bounded=True)
    return keyed.select("trip_id", "rating", "comment", "feedback_category_key")


def build_fact(
    trips: DataFrame,
    dimensions: Mapping[str, DataFrame],
    policy: Mapping[str, MissPolicy],
    source: str | Column,
    batch_id: str,
    feedback: DataFrame | None = None,
    columns: Sequence[str] = FACT_FULL_COLUMNS,
    loaded_at: Column | None = None,
) -> DataFrame:
    """FB-A, FB-B, FB-C: look up every dimension given and lay the row out.

    ``policy`` says per look-up what a miss does: ``unknown``, ``null`` or ``drop``. A dimension
    that is not given (J5) leaves its key null, or unknown under that policy. ``feedback`` is
    the result of ``feedback_with_category``. It is joined first: trips that were just
    deduplicated by trip id still lie partitioned that way, so that join moves no trip.
    """
    fact = trips
    if feedback is not None:
        side = feedback.select(
            F.col("trip_id").alias("_trip_id"), "rating", "comment", "feedback_category_key"
        )
        fact = fact.join(side, fact["trip_id"] == side["_trip_id"], "left").drop("_trip_id")

    if "rider" in dimensions:
        fact = fact.drop("card_bank")
    for name, miss in policy.items():
        column, dimension, natural_key, take, bounded = LOOKUPS[name]
        if dimension in dimensions:
            fact = look_up(
                fact, dimensions[dimension], (column, natural_key), take, miss, bounded
            )
        else:
            key = next(iter(take.values()))
            value = F.lit(presets.UNKNOWN_KEY if miss == "unknown" else None)
            fact = fact.withColumn(key, value.cast("bigint"))

    absent = {c: F.lit(None).cast(t) for c, t in _OPTIONAL_COLUMNS.items()}
    fact = fact.withColumns({c: v for c, v in absent.items() if c not in fact.columns})
    unknown = F.lit(presets.UNKNOWN_KEY)
    fact = fact.withColumns(
        {
            "feedback_category_key": F.coalesce("feedback_category_key", unknown),
            "has_feedback": flag(F.col("rating").isNotNull()),
        }
    )
    fact = with_lineage(fact, source, batch_id, loaded_at)
    extra = ["loaded_at"] if loaded_at is not None else []
    return fact.select(*columns, *extra)


def lookup_misses(
    trips: DataFrame, dimensions: Mapping[str, DataFrame], names: Sequence[str]
) -> DataFrame:
    """Per look-up, how many trips have no member.

    The trips are read, and made unique where they have to be, once for all look-ups.
    """
    joined = trips.select(*{LOOKUPS[name][0] for name in names})
    for name in names:
        column, dimension, natural_key, _, _ = LOOKUPS[name]
        members = dimensions[dimension].select(F.col(natural_key).alias(f"_{name}")).distinct()
        joined = joined.join(members, F.col(column) == F.col(f"_{name}"), "left")
    missed = [F.count_if(F.col(f"_{name}").isNull()).alias(f"_{name}") for name in names]
    lines = [
        F.struct(F.lit(name).alias("look_up"), F.col(f"_{name}").alias("missed")) for name in names
    ]
    return joined.agg(*missed).select(F.inline(F.array(*lines)))
