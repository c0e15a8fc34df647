"""The five reports over the star schema.

Each report first adds the fact up per dimension key and joins the dimension to those sums. The
fact is therefore shuffled as partial sums only, whatever the size of the dimension and however
many rows one key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart import presets

SUM_KEYS = (
    "date_key", "route_key", "card_bank", "tap_in_hour", "day_part", "direction", "is_success",
    "is_free",
)
PROFILE = ("age_band", "rider_segment", "card_bank", "gender")


def _add_up(fact: DataFrame, *keys: str) -> DataFrame:
    if "_paid_rows" in fact.columns:
        # Rows of ``trip_sums``: the fact is added up in part.
        parts = fact.groupBy(*keys).agg(
            *_totals("trips", "_paid", "_paid_rows", "_minutes", "_minute_rows")
        )
        return parts.withColumn("_paid", F.col("_paid").cast("decimal(20,2)"))
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("paid").alias("_paid"),
        F.count("paid").alias("_paid_rows"),
        F.sum("duration_min").alias("_minutes"),
        F.count("duration_min").alias("_minute_rows"),
    )


def _totals(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _average_minutes() -> Column:
    return F.round(F.try_divide(F.col("_minutes").cast("double"), F.col("_minute_rows")), 1)


def _average_paid() -> Column:
    # Six decimals is what averaging a money column gives.
    mean = F.try_divide(F.col("_paid"), F.col("_paid_rows")).cast("decimal(14,6)")
    return F.round(mean, 0).cast("double")


def _members(dimension: DataFrame, key: str, include_unknown: bool) -> DataFrame:
    return dimension if include_unknown else dimension.where(F.col(key) != presets.UNKNOWN_KEY)


def daily_trend(fact: DataFrame, dim_date: DataFrame, include_unknown: bool = True) -> DataFrame:
    """Q1: successful trips, revenue and average minutes per day."""
    sums = _add_up(fact.where("is_success = 1"), "date_key")
    days = _members(dim_date, "date_key", include_unknown)
    return (
        sums.join(days, "date_key")
        .groupBy("date", "day_name", "is_weekend")
        .agg(*_totals("trips", "_paid", "_minutes", "_minute_rows"))
        .select(
            "date",
            "day_name",
            "is_weekend",
            "trips",
            F.col("_paid").cast("decimal(20,2)").alias("revenue"),
            _average_minutes().alias("avg_minutes"),
        )
        .orderBy("date")
    )


def daily_rollup(fact: DataFrame, dim_date: DataFrame, include_unknown: bool = True) -> DataFrame:
    """A10: the same measures per day, month and year, and in total.

    ``level`` is 0 for a day, 1 for a month, 3 for a year and 7 for the total.
    """
    sums = _add_up(fact.where("is_success = 1"), "date_key")
    days = _members(dim_date, "date_key", include_unknown)
    return (
        sums.join(days, "date_key")
        .rollup("year", "month", "date")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            *_totals("trips", "_paid", "_minutes", "_minute_rows"),
        )
        .select(
            "year",
            "month",
            "date",
            "level",
            "trips",
            F.col("_paid").cast("decimal(20,2)").alias("revenue"),
            _average_minutes().alias("avg_minutes"),
        )
        .orderBy("level", "year", "month", "date")
    )


def corridor_bank(fact: DataFrame, dim_route: DataFrame, include_unknown: bool = True) -> DataFrame:
    """Q2: successful trips, revenue and average minutes per corridor type and card bank."""
    sums = _add_up(fact.where("is_success = 1"), "route_key", "card_bank")
    members = _members(dim_route, "route_key", include_unknown)
    return (
        sums.join(members.select("route_key", "corridor_type"), "route_key")
        .groupBy("corridor_type", "card_bank")
        .agg(*_totals("trips", "_paid", "_minutes", "_minute_rows"))
        .select(
            "corridor_type",
            "card_bank",
            "trips",
            F.col("_paid").cast("decimal(20,2)").alias("revenue"),
            _average_minutes().alias("avg_minutes"),
        )
        .orderBy(F.desc("trips"), "corridor_type", "card_bank")
    )


def hour_direction(fact: DataFrame, dim_date: DataFrame, include_unknown: bool = True) -> DataFrame:
    """Q3: completed trips and average payment on working days per hour and direction.

    The unknown date counts as a working day unless it is left out.
    """
    done = fact.where("is_success = 1 OR is_free = 1")
    sums = _add_up(done, "date_key", "tap_in_hour", "day_part", "direction")
    working_days = _members(dim_date, "date_key", include_unknown).where("is_weekend = 0")
    return (
        sums.join(working_days.select("date_key"), "date_key")
        .groupBy("tap_in_hour", "day_part", "direction")
        .agg(*_totals("trips", "_paid", "_paid_rows"))
        .select(
            "tap_in_hour", "day_part", "direction", "trips", _average_paid().alias("avg_paid")
        )
        .orderBy("tap_in_hour", "direction")
    )


def rider_profile(
    fact: DataFrame,
    dim_rider: DataFrame,
    include_unknown: bool = True,
    approximate: bool = False,
) -> DataFrame:
    """Q4: successful trips, riders and average payment per age band, segment, bank and gender.

    The bank is the rider's. With ``approximate`` the riders are counted by sketch.
    """
    sums = _add_up(fact.where("is_success = 1"), "rider_key")
    members = _members(dim_rider, "rider_key", include_unknown)
    profile = ["age_band", "rider_segment", "card_bank", "gender"]
    count_riders = F.approx_count_distinct if approximate else F.count_distinct
    return (
        sums.join(members.select("rider_key", "rider_id", *profile), "rider_key")
        .groupBy(*profile)
        .agg(*_totals("trips", "_paid", "_paid_rows"), count_riders("rider_id").alias("riders"))
        .select(*profile, "trips", "riders", _average_paid().alias("avg_paid"))
        .orderBy(F.desc("trips"), *profile)
    )


def trip_sums(fact: DataFrame) -> DataFrame:
    """A10: trips, payments and minutes per day, route, bank, hour, direction and outcome.

    These rows, from one fact or from several parts of it, can be given to the reports on days,
    routes and hours in place of the fact.
    """
    sums = _add_up(fact, *SUM_KEYS)
    return sums.withColumn("_paid", F.col("_paid").cast("decimal(20,2)"))


def rider_sums(fact: DataFrame, dim_rider: DataFrame, sketch_bits: int) -> DataFrame:
    """A4: successful trips, payments and a mergeable sketch of the riders per day and profile."""
    success = fact.where("is_success = 1").drop("card_bank")
    sums = _add_up(success, "date_key", "rider_key")
    members = dim_rider.select("rider_key", "rider_id", *PROFILE)
    known = (F.col("rider_key") != presets.UNKNOWN_KEY).alias("is_known")
    return (
        sums.join(members, "rider_key")
        .groupBy("date_key", known, *PROFILE)
        .agg(
            *_totals("trips", "_paid_rows"),
            F.sum("_paid").cast("decimal(20,2)").alias("_paid"),
            F.hll_sketch_agg("rider_id", F.lit(sketch_bits)).alias("_riders"),
        )
    )


def rider_profile_from_sums(sums: DataFrame, include_unknown: bool = True) -> DataFrame:
    """Q4 from rows of ``rider_sums`` of any days: the riders are counted by merging sketches."""
    rows = sums if include_unknown else sums.where("is_known")
    return (
        rows.groupBy(*PROFILE)
        .agg(
            *_totals("trips", "_paid", "_paid_rows"),
            F.hll_sketch_estimate(F.hll_union_agg("_riders")).alias("riders"),
        )
        .select(*PROFILE, "trips", "riders", _average_paid().alias("avg_paid"))
        .orderBy(F.desc("trips"), *PROFILE)
    )


def top_stops(
    fact: DataFrame, dim_stop: DataFrame, top: int = 10, include_unknown: bool = True
) -> DataFrame:
    """Q5: the busiest boarding stops, all that share the last rank included.

    The rank filter is applied on every partition of the stop totals before they meet.
    """
    per_key = fact.groupBy("board_stop_key").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("status") == presets.STATUS_INCOMPLETE).alias("incomplete"),
        F.count_if(F.col("is_free") == 1).alias("free"),
        F.sum("paid").alias("_paid"),
        F.count("paid").alias("_paid_rows"),
    )
    members = _members(dim_stop, "stop_key", include_unknown)
    stops = members.select(F.col("stop_key").alias("board_stop_key"), "stop_id", "stop_name")
    per_stop = (
        per_key.join(stops, "board_stop_key")
        .groupBy("stop_id", "stop_name")
        .agg(*_totals("trips", "incomplete", "free", "_paid", "_paid_rows"))
    )
    ranking = F.rank().over(Window.orderBy(F.desc("trips")))
    share = F.try_divide(F.col("incomplete").cast("double"), F.col("trips")) * 100
    return (
        per_stop.withColumn("ranking", ranking)
        .where(F.col("ranking") <= top)
        .select(
            "stop_id",
            "stop_name",
            "trips",
            "incomplete",
            "free",
            _average_paid().alias("avg_paid"),
            F.round(share, 1).alias("pct_incomplete"),
            "ranking",
        )
        .orderBy("ranking", "stop_id")
    )
