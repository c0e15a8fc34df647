"""Derived columns on the tap rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.functions import casts, riders, routes
from tapmart.functions import trips as t
from tapmart.operators import cleaning, trips
from tapmart.queries.registry import query


def _taps_with(spark, sf_dir, *inputs: str, **derived: Column):
    columns = [c.alias(name) for name, c in derived.items()]
    return testviews.taps(spark, sf_dir).select("transID", "ingest_seq", *inputs, *columns)


CORRIDOR_CASES = (
    " ".join(f"WHEN regexp_matches({{0}}, '{p}') THEN '{v}'" for p, v in presets.CORRIDOR_TYPES)
    + f" ELSE '{presets.CORRIDOR_TYPE_DEFAULT}' END"
)
CORRIDOR_TYPE = "CASE " + CORRIDOR_CASES
CORRIDOR_TYPE_OR_OTHER = (
    "CASE WHEN {0} IS NULL OR {0} IN ('UNKNOWN', '') THEN 'Lainnya' " + CORRIDOR_CASES
)


@query(
    "derive_corridor_type",
    f"""SELECT transID, ingest_seq, corridorID,
    {CORRIDOR_TYPE.format("corridorID")} AS corridor_type FROM taps""",
)
def derive_corridor_type(spark, sf_dir):
    value = routes.corridor_type(F.col("corridorID"))
    return _taps_with(spark, sf_dir, "corridorID", corridor_type=value)


@query(
    "derive_corridor_type_or_other",
    f"""SELECT transID, ingest_seq, corridorID,
    {CORRIDOR_TYPE_OR_OTHER.format("corridorID")} AS corridor_type FROM taps""",
)
def derive_corridor_type_or_other(spark, sf_dir):
    value = routes.corridor_type_or_other(F.col("corridorID"))
    return _taps_with(spark, sf_dir, "corridorID", corridor_type=value)


@query(
    "derive_origin_destination",
    """SELECT transID, ingest_seq, corridorName,
    trim(string_split(corridorName, ' - ')[1]) AS origin,
    trim(string_split(corridorName, ' - ')[2]) AS destination FROM taps""",
)
def derive_origin_destination(spark, sf_dir):
    name = F.col("corridorName")
    return _taps_with(
        spark,
        sf_dir,
        "corridorName",
        origin=routes.origin(name),
        destination=routes.destination(name),
    )


FIRST_ORIGIN = """CASE WHEN {0} IS NULL THEN '' WHEN position(' - ' IN {0}) = 0 THEN {0}
    ELSE trim(substr({0}, 1, position(' - ' IN {0}) - 1)) END"""
FIRST_DESTINATION = """CASE WHEN {0} IS NULL OR position(' - ' IN {0}) = 0 THEN ''
    ELSE trim(substr({0}, position(' - ' IN {0}) + 3)) END"""


@query(
    "derive_origin_destination_first",
    f"""SELECT transID, ingest_seq, corridorName, {FIRST_ORIGIN.format("corridorName")} AS origin,
    {FIRST_DESTINATION.format("corridorName")} AS destination FROM taps""",
)
def derive_origin_destination_first(spark, sf_dir):
    name = F.col("corridorName")
    return _taps_with(
        spark,
        sf_dir,
        "corridorName",
        origin=routes.origin_first_split(name),
        destination=routes.destination_first_split(name),
    )


DAY_PART = """CASE WHEN hour({0}) BETWEEN 5 AND 9 THEN 'Pagi'
    WHEN hour({0}) BETWEEN 10 AND 14 THEN 'Siang'
    WHEN hour({0}) BETWEEN 15 AND 18 THEN 'Sore' ELSE 'Malam' END"""


@query(
    "derive_day_part",
    f"""SELECT transID, ingest_seq, CAST(hour(tapInTime) AS INTEGER) AS tap_in_hour,
    {DAY_PART.format("tapInTime")} AS day_part FROM taps""",
)
def derive_day_part(spark, sf_dir):
    hour = t.tap_in_hour(F.col("tapInTime"))
    return _taps_with(spark, sf_dir, tap_in_hour=hour, day_part=t.day_part(hour))


DURATION = """CAST(trunc((epoch(date_trunc('second', {1})) - epoch(date_trunc('second', {0}))) / 60)
    AS SMALLINT)"""
DURATION_HALF_EVEN = """CAST(round_even((epoch_us({1}) - epoch_us({0})) / 60000000, 0) AS SMALLINT)"""


@query(
    "derive_duration_trunc",
    f"""SELECT transID, ingest_seq, {DURATION.format("tapInTime", "tapOutTime")} AS duration_min,
    {DURATION.format("tapOutTime", "tapInTime")} AS reversed_min FROM taps""",
)
def derive_duration_trunc(spark, sf_dir):
    tap_in, tap_out = F.col("tapInTime"), F.col("tapOutTime")
    return _taps_with(
        spark,
        sf_dir,
        duration_min=t.duration_truncated(tap_in, tap_out),
        reversed_min=t.duration_truncated(tap_out, tap_in),
    )


@query(
    "derive_duration_bankers",
    f"""SELECT transID, ingest_seq,
    {DURATION_HALF_EVEN.format("tapInTime", "tapOutTime")} AS duration_min FROM taps""",
)
def derive_duration_bankers(spark, sf_dir):
    value = t.duration_half_even(F.col("tapInTime"), F.col("tapOutTime"))
    return _taps_with(spark, sf_dir, duration_min=value)


@query(
    "derive_travel_date",
    "SELECT transID, ingest_seq, CAST(tapInTime AS DATE) AS travel_date FROM taps",
)
def derive_travel_date(spark, sf_dir):
    return _taps_with(spark, sf_dir, travel_date=t.travel_date(F.col("tapInTime")))


STATUS = """CASE WHEN {0} IS NULL THEN 'Incomplete' WHEN {1} = 0 THEN 'Gratis' ELSE 'Sukses' END"""


@query(
    "derive_status",
    f"""SELECT trip_id, ingest_seq, status, CASE WHEN status = 'Sukses' THEN 1 ELSE 0 END
    AS is_success, CASE WHEN status = 'Gratis' THEN 1 ELSE 0 END AS is_free FROM
    (SELECT trip_id, ingest_seq, {STATUS.format("tap_out_at", "paid")} AS status
    FROM trip_table)""",
)
def derive_status(spark, sf_dir):
    rows = testviews.trip_table(spark, sf_dir)
    return trips.with_status(rows).select(
        "trip_id", "ingest_seq", "status", "is_success", "is_free"
    )


@query(
    "status_passthrough_flags",
    """SELECT trip_id, ingest_seq, CASE WHEN status LIKE 'Inkompl%' THEN 'Incomplete' ELSE status
    END AS status, CAST(status = 'Sukses' AS INTEGER) AS is_success,
    CAST(status = 'Gratis' AS INTEGER) AS is_free FROM trip_table""",
)
def status_passthrough_flags(spark, sf_dir):
    rows = testviews.trip_table(spark, sf_dir)
    return trips.with_status(rows, derive=False).select(
        "trip_id", "ingest_seq", "status", "is_success", "is_free"
    )


def _rider_ages(spark, sf_dir, reference_year=presets.REFERENCE_YEAR):
    rows = testviews.rider_table(spark, sf_dir)
    return rows.withColumn("age", riders.age(F.col("birth_year"), reference_year))


@query(
    "derive_age",
    """SELECT rider_id, birth_year, CAST(2023 - birth_year AS INTEGER) AS age,
    CAST(2026 - birth_year AS INTEGER) AS age_2026 FROM rider_table""",
)
def derive_age(spark, sf_dir):
    later = riders.age(F.col("birth_year"), 2026).alias("age_2026")
    return _rider_ages(spark, sf_dir).select("rider_id", "birth_year", "age", later)


AGE_BAND_EXCLUSIVE = """CASE WHEN {0} < 20 THEN '< 20 Tahun' WHEN {0} < 31 THEN '20-30 Tahun'
    WHEN {0} < 41 THEN '31-40 Tahun' WHEN {0} < 55 THEN '41-54 Tahun' ELSE '>= 55 Tahun' END"""
AGE_BAND_INCLUSIVE = """CASE WHEN {0} <= 22 THEN '<= 22 thn' WHEN {0} <= 32 THEN '23-32 thn'
    WHEN {0} <= 42 THEN '33-42 thn' WHEN {0} <= 52 THEN '43-52 thn' ELSE '>= 53 thn' END"""
AGE_BAND_NULL_AWARE = (
    "CASE WHEN {0} IS NULL THEN 'Tidak Diketahui' ELSE " + AGE_BAND_INCLUSIVE + " END"
)
SEGMENT_EXCLUSIVE = """CASE WHEN {0} < 20 THEN 'Pelajar' WHEN {0} < 25 THEN 'Mahasiswa'
    WHEN {0} < 55 THEN 'Pekerja' ELSE 'Lansia' END"""
SEGMENT_INCLUSIVE = """CASE WHEN {0} <= 17 THEN 'Pelajar' WHEN {0} <= 24 THEN 'Mahasiswa'
    WHEN {0} <= 55 THEN 'Pekerja' ELSE 'Lansia' END"""
SEGMENT_NULL_AWARE = (
    "CASE WHEN {0} IS NULL THEN 'Tidak Diketahui' ELSE " + SEGMENT_INCLUSIVE + " END"
)


def _age_band(spark, sf_dir, table):
    band = riders.age_band(F.col("age"), table).alias("age_band")
    return _rider_ages(spark, sf_dir).select("rider_id", "age", band)


def _age_band_sql(case: str) -> str:
    return f"""SELECT rider_id, age, {case.format("age")} AS age_band FROM
        (SELECT rider_id, CAST(2023 - birth_year AS INTEGER) AS age FROM rider_table)"""


@query("age_band_exclusive", _age_band_sql(AGE_BAND_EXCLUSIVE))
def age_band_exclusive(spark, sf_dir):
    return _age_band(spark, sf_dir, presets.AGE_BANDS_EXCLUSIVE)


@query("age_band_inclusive", _age_band_sql(AGE_BAND_INCLUSIVE))
def age_band_inclusive(spark, sf_dir):
    return _age_band(spark, sf_dir, presets.AGE_BANDS_INCLUSIVE)


@query("age_band_null_unknown", _age_band_sql(AGE_BAND_NULL_AWARE))
def age_band_null_unknown(spark, sf_dir):
    return _age_band(spark, sf_dir, presets.AGE_BANDS_NULL_AWARE)


@query(
    "rider_segment",
    f"""SELECT rider_id, {SEGMENT_EXCLUSIVE.format("age")} AS segment_exclusive,
    {SEGMENT_INCLUSIVE.format("age")} AS segment_inclusive,
    {SEGMENT_NULL_AWARE.format("age")} AS segment_null_unknown
    FROM (SELECT rider_id, 2023 - birth_year AS age FROM rider_table)""",
)
def rider_segment(spark, sf_dir):
    age = F.col("age")
    return _rider_ages(spark, sf_dir).select(
        "rider_id",
        riders.segment(age, presets.SEGMENTS_EXCLUSIVE).alias("segment_exclusive"),
        riders.segment(age, presets.SEGMENTS_INCLUSIVE).alias("segment_inclusive"),
        riders.segment(age, presets.SEGMENTS_NULL_AWARE).alias("segment_null_unknown"),
    )


METRO = ", ".join(f"'{name}'" for name in presets.METRO_CITIES)


@query(
    "derive_region",
    f"""SELECT rider_id, home_city, CASE WHEN home_city IN ({METRO}) THEN 'Jabodetabek'
    ELSE 'Lainnya' END AS region, 'Tidak Diketahui' AS region_without_city FROM rider_table""",
)
def derive_region(spark, sf_dir):
    return testviews.rider_table(spark, sf_dir).select(
        "rider_id",
        "home_city",
        riders.region(F.col("home_city")).alias("region"),
        riders.region(None).alias("region_without_city"),
    )


FLEET_ID = """'ARM-' || coalesce(trim({0}), 'UNK') || '-' || coalesce(CAST({1} AS VARCHAR), '0')
    || '-' || coalesce(strftime({2}, '%Y%m%d'), '00000000')"""


@query(
    "derive_fleet_id",
    f"""SELECT transID, ingest_seq,
    {FLEET_ID.format("corridorID", "direction", "tapInTime")} AS fleet_id FROM taps""",
)
def derive_fleet_id(spark, sf_dir):
    day = t.travel_date(F.col("tapInTime"))
    value = routes.fleet_id(F.col("corridorID"), F.col("direction"), day)
    return _taps_with(spark, sf_dir, fleet_id=value)


@query(
    "scd_columns",
    """SELECT stop_id, DATE '2024-02-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
    1 AS is_current FROM stop_table""",
)
def scd_columns(spark, sf_dir):
    stops = testviews.stop_table(spark, sf_dir).select("stop_id")
    return cleaning.with_validity(stops, F.lit("2024-02-01").cast("date"))


@query(
    "lineage_columns",
    "SELECT transID, ingest_seq, 'csv' AS source, 'batch-1' AS batch_id FROM taps",
)
def lineage_columns(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir).select("transID", "ingest_seq")
    return cleaning.with_lineage(rows, "csv", "batch-1")
