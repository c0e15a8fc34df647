"""Trip rows: cleaning of file rows and table rows, and their derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions import casts, routes, rules
from tapmart.functions import trips as t
from tapmart.operators.cleaning import (
    drop_nulls,
    ensure_columns,
    fill_nulls,
    require_columns,
    trim_all,
)
from tapmart.operators.dedup import first, latest


# Our names of the text columns that are cleaned after rows were made unique.
_TEXTS = {
    "payCardName": "rider_name",
    "payCardBank": "card_bank",
    "payCardSex": "gender",
    "corridorID": "route_id",
    "corridorName": "route_name",
    "tapInStopsName": "board_stop_name",
    "tapOutStops": "alight_stop_id",
    "tapOutStopsName": "alight_stop_name",
}


# Reasons for which a file row is no trip, as they stand in the table of rejected rows.
MALFORMED = "record cannot be read"
MISSING = "required value is missing"
BAD_TIME = "tap-in time cannot be read"
BAD_CARD = "card id is no whole number"
BAD_AMOUNT = "amount does not fit its column"
REJECT_REASONS = (MALFORMED, MISSING, BAD_TIME, BAD_CARD, BAD_AMOUNT)
BAD_RECORD = "bad_record"


def incomplete_reason(rows: DataFrame) -> Column:
    """Why a row can't be taken as it is, before any typing; null where it can."""
    missing = F.lit(False)
    for name in presets.NOT_NULL_FILE_COLUMNS:
        trimmed = casts.trim_blanks(F.col(name).cast("string"))
        missing = missing | trimmed.isNull() | (trimmed == "nan")
    malformed = F.col(BAD_RECORD).isNotNull() if BAD_RECORD in rows.columns else F.lit(False)
    return F.when(malformed, MALFORMED).when(missing, MISSING)


def typed_reason() -> Column:
    """Why a typed row, the one that counts for its trip, is no trip; null where it is one."""
    return (
        F.when(F.col("tap_in_at").isNull(), BAD_TIME)
        .when(F.col("rider_id").isNull(), BAD_CARD)
        .when(F.col("paid").isNull(), BAD_AMOUNT)
    )


def type_file_rows(
    rows: DataFrame, arrival: Sequence[str], time_formats: Sequence[str] = ()
) -> DataFrame:
    """Complete file rows, numbers and times typed, under our names.

    An amount that is no number counts as nothing paid; one too large for its column is null.
    Conversions skip outer blanks by themselves and give null for texts that stand for no value,
    so only the columns that must not be null are trimmed here.
    """
    require_columns(rows, presets.REQUIRED_FILE_COLUMNS)
    absent = {name: F.lit(None).cast("string") for name in presets.OPTIONAL_FILE_COLUMNS}
    absent["direction"] = F.lit("0")
    rows = trim_all(ensure_columns(rows, absent), columns=presets.NOT_NULL_FILE_COLUMNS)
    rows = drop_nulls(rows, presets.NOT_NULL_FILE_COLUMNS)
    return rows.select(
        F.col("transID").alias("trip_id"),
        casts.try_number(F.col("payCardID"), "bigint").alias("rider_id"),
        casts.try_number(F.col("payCardBirthDate"), "int").alias("birth_year"),
        casts.try_number(F.col("direction"), "smallint").alias("direction"),
        F.col("tapInStops").alias("board_stop_id"),
        casts.try_number(F.col("tapInStopsLat"), "decimal(10,7)").alias("board_lat"),
        casts.try_number(F.col("tapInStopsLon"), "decimal(10,7)").alias("board_lon"),
        casts.try_number(F.col("stopStartSeq"), "smallint").alias("board_seq"),
        casts.try_number(F.col("tapOutStopsLat"), "decimal(10,7)").alias("alight_lat"),
        casts.try_number(F.col("tapOutStopsLon"), "decimal(10,7)").alias("alight_lon"),
        casts.try_number(F.col("stopEndSeq"), "smallint").alias("alight_seq"),
        casts.try_timestamp(F.col("tapInTime"), time_formats).alias("tap_in_at"),
        casts.try_timestamp(F.col("tapOutTime"), time_formats).alias("tap_out_at"),
        F.coalesce(casts.try_number(F.col("payAmount"), "decimal(38,6)"), F.lit(0))
        .try_cast("decimal(10,2)")
        .alias("paid"),
        *[F.col(name).alias(ours) for name, ours in _TEXTS.items()],
        *arrival,
    )


def clean_texts(trips: DataFrame) -> DataFrame:
    """Texts trimmed, categories checked, defaults filled, birth years bounded."""
    trimmed = trim_all(trips, columns=_TEXTS.values())
    folded = trimmed.withColumns({"card_bank": F.lower("card_bank"), "gender": F.upper("gender")})
    bank, gender = F.col("card_bank"), F.col("gender")
    return folded.withColumns(
        {
            "card_bank": rules.listed_or(bank, presets.CARD_BANKS, presets.OTHER_BANK),
            "gender": rules.listed_or(gender, presets.GENDERS, presets.GENDER_NOT_GIVEN),
            "birth_year": casts.in_range(F.col("birth_year"), *presets.BIRTH_YEAR_RANGE),
            "route_id": F.coalesce("route_id", F.lit(presets.UNKNOWN_ID)),
            "route_name": F.coalesce("route_name", F.lit(presets.NOT_KNOWN)),
        }
    )


def clean_file_rows(
    rows: DataFrame, arrival: Sequence[str], file_column: str | None = None
) -> DataFrame:
    """File rows cleaned: typed, then one row per trip id, then only rows with a tap-in time.

    With ``file_column`` one row is kept per trip id and file, as if every file were cleaned on
    its own. The first row of a trip id is chosen before bad tap-in times are dropped, so a trip
    whose first row has a bad time is left out.

    Typing comes before the shuffle, where it makes rows small; the texts are cleaned after it,
    on fewer rows. Either side then is a step small enough for the JVM to compile in one piece.
    """
    key = ["trip_id", file_column] if file_column else "trip_id"
    unique = first(type_file_rows(rows, arrival), key, arrival)
    return clean_texts(drop_nulls(unique, ["tap_in_at"]))


def judged_file_rows(
    rows: DataFrame,
    arrival: Sequence[str],
    file_column: str | None = None,
    time_formats: Sequence[str] = (),
) -> DataFrame:
    """``clean_file_rows`` with the rows that are no trip kept, under a ``reject_reason``.

    Rows without a reason are the same as there, but for those whose card id or amount is bad.
    """
    key = ["trip_id", file_column] if file_column else "trip_id"
    complete = rows.where(incomplete_reason(rows).isNull())
    unique = first(type_file_rows(complete, arrival, time_formats), key, arrival)
    return clean_texts(unique).withColumn("reject_reason", typed_reason())


def with_trip_times(trips: DataFrame, half_even: bool = False) -> DataFrame:
    """D3-D6."""
    tap_in, tap_out = F.col("tap_in_at"), F.col("tap_out_at")
    duration = t.duration_half_even if half_even else t.duration_truncated
    hour = t.tap_in_hour(tap_in)
    return trips.withColumns(
        {
            "travel_date": t.travel_date(tap_in),
            "tap_in_hour": hour,
            "day_part": t.day_part(hour),
            "duration_min": duration(tap_in, tap_out),
        }
    )


def with_status(trips: DataFrame, derive: bool = True) -> DataFrame:
    """D7, D7', D8: status from tap-out and payment, or as stored; and its flags."""
    if derive:
        status = t.status(F.col("tap_out_at"), F.col("paid"))
    else:
        status = t.normal_status(F.col("status"))
    return trips.withColumn("status", status).withColumns(
        {
            "is_success": t.flag(F.col("status") == presets.STATUS_SUCCESS),
            "is_free": t.flag(F.col("status") == presets.STATUS_FREE),
        }
    )


def with_fleet_id(trips: DataFrame) -> DataFrame:
    """D13."""
    value = routes.fleet_id(F.col("route_id"), F.col("direction"), F.col("travel_date"))
    return trips.withColumn("fleet_id", value)


def derive_file_trips(trips: DataFrame, half_even: bool = True) -> DataFrame:
    """All derived columns of cleaned file rows."""
    return with_fleet_id(with_status(with_trip_times(trips, half_even)))


def complete_trips(trips: DataFrame) -> DataFrame:
    """Table rows without what the source table lacks, filled in."""
    trips = drop_nulls(trips, ["tap_in_at"])
    trips = ensure_columns(
        trips,
        {
            "fleet_id": F.lit(None).cast("string"),
            "discount": F.lit(0).cast("decimal(10,2)"),
            "fare": F.col("paid"),
            "pay_method": F.lit(None).cast("string"),
        },
    )
    return fill_nulls(
        trips,
        {
            "alight_stop_id": presets.UNKNOWN_ID,
            "fleet_id": presets.UNKNOWN_ID,
            "discount": 0,
        },
    )


def clean_table_trips(trips: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Table rows completed, the newest per trip id, with time and stored status columns."""
    newest = latest(
        complete_trips(trips), "trip_id", tie_break=[F.col(name) for name in tie_break]
    )
    return with_status(with_trip_times(newest), derive=False)
