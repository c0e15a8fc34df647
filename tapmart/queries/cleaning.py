"""Cleaning operators on the tap rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.functions import casts, rules
from tapmart.operators import cleaning, trips
from tapmart.operators.reporting import validation_report
from tapmart.queries.registry import part, query
from tapmart.sources.tables import read_parquet

BANKS = ", ".join(f"'{name}'" for name in presets.CARD_BANKS)


@query(
    "src_pushdown_filter",
    """SELECT event_id, user_id, event_type, value FROM events
    WHERE event_type IN ('signup', 'purchase')""",
)
def src_pushdown_filter(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "value"]
    kept = F.col("event_type").isin("signup", "purchase")
    return read_parquet(spark, f"{sf_dir}/events.parquet", columns=columns, where=kept)


@query(
    "clean_trim",
    """SELECT transID, ingest_seq, trim(corridorName) AS corridorName,
    trim(payCardBank) AS payCardBank FROM taps""",
)
def clean_trim(spark, sf_dir):
    taps = testviews.taps(spark, sf_dir)
    return cleaning.trim_columns(taps, ["corridorName", "payCardBank", "noSuchColumn"]).select(
        "transID", "ingest_seq", "corridorName", "payCardBank"
    )


@query(
    "clean_trim_all",
    """SELECT trim(transID) AS transID, ingest_seq, trim(corridorName) AS corridorName,
    nullif(trim(coalesce(payCardBank, ' nan ')), 'nan') AS payCardBank FROM taps""",
)
def clean_trim_all(spark, sf_dir):
    taps = testviews.taps(spark, sf_dir)
    bank = F.coalesce("payCardBank", F.lit(" nan "))
    rows = taps.select("transID", "ingest_seq", "corridorName", bank.alias("payCardBank"))
    return cleaning.trim_all(rows)


@query(
    "clean_drop_null",
    """SELECT transID, ingest_seq, corridorID, direction FROM taps
    WHERE corridorID IS NOT NULL AND direction IS NOT NULL""",
)
def clean_drop_null(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir).select("transID", "ingest_seq", "corridorID", "direction")
    return cleaning.drop_nulls(rows, ["corridorID", "direction"])


@query(
    "clean_fill_null",
    """SELECT transID, ingest_seq, coalesce(tapOutStops, 'UNKNOWN') AS tapOutStops,
    coalesce(direction, 0) AS direction FROM taps""",
)
def clean_fill_null(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir).select("transID", "ingest_seq", "tapOutStops", "direction")
    return cleaning.fill_nulls(rows, {"tapOutStops": presets.UNKNOWN_ID, "direction": 0})


@query(
    "ensure_columns",
    """SELECT trip_id, ingest_seq, coalesce(alight_stop_id, 'UNKNOWN') AS alight_stop_id,
    'UNKNOWN' AS fleet_id, CAST(0 AS DECIMAL(10,2)) AS discount, paid, paid AS fare,
    CAST(NULL AS VARCHAR) AS pay_method FROM trip_table WHERE tap_in_at IS NOT NULL""",
)
def ensure_columns(spark, sf_dir):
    return trips.complete_trips(testviews.trip_table(spark, sf_dir)).select(
        "trip_id",
        "ingest_seq",
        "alight_stop_id",
        "fleet_id",
        "discount",
        "paid",
        "fare",
        "pay_method",
    )


@query(
    "clean_optional_defaults",
    """SELECT transID, ingest_seq, 0 AS direction, coalesce(corridorID, 'UNKNOWN') AS corridorID,
    coalesce(corridorName, 'Tidak Diketahui') AS corridorName, 0 AS payAmount FROM taps""",
)
def clean_optional_defaults(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir).select(
        "transID", "ingest_seq", "corridorID", "corridorName"
    )
    return cleaning.default_columns(
        rows,
        {
            "direction": F.lit(0),
            "corridorID": F.lit(presets.UNKNOWN_ID),
            "corridorName": F.lit(presets.NOT_KNOWN),
            "payAmount": F.lit(0),
        },
    )


@query(
    "clean_whitelist_bank",
    f"""SELECT transID, ingest_seq, payCardBank, CASE WHEN lower(trim(payCardBank)) IN ({BANKS})
    THEN lower(trim(payCardBank)) ELSE 'lainnya' END AS card_bank FROM taps""",
)
def clean_whitelist_bank(spark, sf_dir):
    bank = rules.whitelist(F.col("payCardBank"), presets.CARD_BANKS, presets.OTHER_BANK)
    return testviews.taps(spark, sf_dir).select(
        "transID", "ingest_seq", "payCardBank", bank.alias("card_bank")
    )


@query(
    "clean_whitelist_gender",
    """SELECT transID, ingest_seq, payCardSex, CASE WHEN upper(trim(payCardSex)) IN ('M', 'F')
    THEN upper(trim(payCardSex)) ELSE 'Tidak Disebutkan' END AS gender FROM taps""",
)
def clean_whitelist_gender(spark, sf_dir):
    gender = rules.whitelist(
        F.col("payCardSex"), presets.GENDERS, presets.GENDER_NOT_GIVEN, case="upper"
    )
    return testviews.taps(spark, sf_dir).select(
        "transID", "ingest_seq", "payCardSex", gender.alias("gender")
    )


@query(
    "clean_try_number",
    """SELECT transID, ingest_seq, payCardBirthDate,
    CAST(TRY_CAST(payCardBirthDate AS DOUBLE) AS INTEGER) AS birth_year,
    CAST(TRY_CAST(payCardBirthDate || '.0' AS DOUBLE) AS BIGINT) AS from_decimal_text,
    TRY_CAST(tapInStopsLat AS DECIMAL(10,7)) AS latitude,
    TRY_CAST(corridorID AS DOUBLE) AS corridor_number FROM taps""",
)
def clean_try_number(spark, sf_dir):
    birth = F.col("payCardBirthDate")
    return testviews.taps(spark, sf_dir).select(
        "transID",
        "ingest_seq",
        "payCardBirthDate",
        casts.try_number(birth, "int").alias("birth_year"),
        casts.try_number(F.concat(birth, F.lit(".0")), "bigint").alias("from_decimal_text"),
        casts.try_number(F.col("tapInStopsLat"), "decimal(10,7)").alias("latitude"),
        casts.try_number(F.col("corridorID")).alias("corridor_number"),
    )


@query(
    "clean_range_null",
    """SELECT transID, ingest_seq, CASE WHEN TRY_CAST(payCardBirthDate AS INTEGER)
    BETWEEN 1940 AND 2015 THEN TRY_CAST(payCardBirthDate AS INTEGER) END AS birth_year
    FROM taps""",
)
def clean_range_null(spark, sf_dir):
    year = casts.try_number(F.col("payCardBirthDate"), "int")
    return testviews.taps(spark, sf_dir).select(
        "transID",
        "ingest_seq",
        casts.in_range(year, *presets.BIRTH_YEAR_RANGE).alias("birth_year"),
    )


@query(
    "clean_try_timestamp",
    """SELECT event_id, TRY_CAST(CASE event_type WHEN 'error' THEN 'no time'
    WHEN 'signup' THEN strftime(ts, '%Y-%m-%d') || ' 25:00:00'
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS tap_at FROM events""",
)
def clean_try_timestamp(spark, sf_dir):
    text = (
        F.when(F.col("event_type") == "error", F.lit("no time"))
        .when(
            F.col("event_type") == "signup",
            F.concat(F.to_date("ts").cast("string"), F.lit(" 25:00:00")),
        )
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return testviews.table(spark, sf_dir, "events").select(
        "event_id", casts.try_timestamp(text).alias("tap_at")
    )


# A file row as the cleaning steps leave it, before one row per trip is kept.
part(
    "p_typed",
    f"""
    SELECT transID AS trip_id, CAST(payCardID AS BIGINT) AS rider_id,
      trim(payCardName) AS rider_name,
      CASE WHEN lower(trim(payCardBank)) IN ({BANKS}) THEN lower(trim(payCardBank))
        ELSE 'lainnya' END AS card_bank,
      CASE WHEN upper(trim(payCardSex)) IN ('M', 'F') THEN upper(trim(payCardSex))
        ELSE 'Tidak Disebutkan' END AS gender,
      CASE WHEN TRY_CAST(payCardBirthDate AS INTEGER) BETWEEN 1940 AND 2015
        THEN TRY_CAST(payCardBirthDate AS INTEGER) END AS birth_year,
      coalesce(trim(corridorID), 'UNKNOWN') AS route_id,
      coalesce(trim(corridorName), 'Tidak Diketahui') AS route_name,
      CAST(direction AS SMALLINT) AS direction,
      tapInStops AS board_stop_id, tapInStopsName AS board_stop_name,
      TRY_CAST(tapInStopsLat AS DECIMAL(10,7)) AS board_lat,
      TRY_CAST(tapInStopsLon AS DECIMAL(10,7)) AS board_lon,
      TRY_CAST(stopStartSeq AS SMALLINT) AS board_seq,
      tapOutStops AS alight_stop_id, tapOutStopsName AS alight_stop_name,
      TRY_CAST(tapOutStopsLat AS DECIMAL(10,7)) AS alight_lat,
      TRY_CAST(tapOutStopsLon AS DECIMAL(10,7)) AS alight_lon,
      TRY_CAST(stopEndSeq AS SMALLINT) AS alight_seq,
      tapInTime AS tap_in_at, tapOutTime AS tap_out_at,
      CAST(coalesce(payAmount, 0) AS DECIMAL(10,2)) AS paid, ingest_seq
    FROM taps WHERE transID IS NOT NULL AND payCardID IS NOT NULL AND tapInStops IS NOT NULL
      AND tapInTime IS NOT NULL""",
)
part(
    "p_clean",
    """SELECT * EXCLUDE position FROM (SELECT *, row_number() OVER (PARTITION BY trip_id
    ORDER BY ingest_seq) AS position FROM p_typed) WHERE position = 1 AND tap_in_at IS NOT NULL""",
)


@query("clean_file_rows", "SELECT * FROM p_clean")
def clean_file_rows(spark, sf_dir):
    return trips.clean_file_rows(testviews.taps(spark, sf_dir), testviews.ARRIVAL)


@query(
    "rows_dropped_report",
    """SELECT 'read' AS step, count(*) AS rows FROM taps
    UNION ALL SELECT 'complete', count(*) FROM p_typed
    UNION ALL SELECT 'unique', count(DISTINCT trip_id) FROM p_typed
    UNION ALL SELECT 'kept', count(*) FROM p_clean
    UNION ALL SELECT 'dropped', (SELECT count(*) FROM taps) - (SELECT count(*) FROM p_clean)""",
)
def rows_dropped_report(spark, sf_dir):
    return validation_report(testviews.taps(spark, sf_dir), testviews.ARRIVAL)
