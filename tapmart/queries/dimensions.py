"""Deduplication, keys and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.operators import dedup, dimensions, keys, trips
from tapmart.plans.from_files import load_date_column, observed_dimensions, stage_trips
from tapmart.queries.derive import (
    AGE_BAND_EXCLUSIVE,
    AGE_BAND_NULL_AWARE,
    CORRIDOR_TYPE,
    CORRIDOR_TYPE_OR_OTHER,
    DAY_PART,
    DURATION,
    DURATION_HALF_EVEN,
    FIRST_DESTINATION,
    FIRST_ORIGIN,
    FLEET_ID,
    SEGMENT_EXCLUSIVE,
    SEGMENT_NULL_AWARE,
    STATUS,
)
from tapmart.queries.registry import part, query

LOAD_DAY = "2024-02-01"
ARRIVAL = testviews.ARRIVAL


def load_date():
    return load_date_column(LOAD_DAY)


def staged(spark, sf_dir, half_even=False):
    return stage_trips(testviews.taps(spark, sf_dir), ARRIVAL, half_even)


def derived(spark, sf_dir):
    """Trips for a single reader, which gain nothing from being written in between."""
    rows = trips.clean_file_rows(testviews.taps(spark, sf_dir), ARRIVAL)
    return trips.derive_file_trips(rows, half_even=False)


VALIDITY = f"DATE '{LOAD_DAY}' AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current"


def numbered(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order})"


# ------------------------------------------------------------------------------- deduplication
@query(
    "dedup_latest",
    """SELECT trip_id, rider_id, tap_in_at, paid, created_at FROM (SELECT *, row_number() OVER
    (PARTITION BY trip_id ORDER BY created_at DESC, ingest_seq DESC) AS position FROM trip_table)
    WHERE position = 1""",
)
def dedup_latest(spark, sf_dir):
    rows = testviews.trip_table(spark, sf_dir)
    return dedup.latest(rows, "trip_id", tie_break=[F.col("ingest_seq").desc()]).select(
        "trip_id", "rider_id", "tap_in_at", "paid", "created_at"
    )


@query(
    "dedup_first",
    """SELECT transID, ingest_seq, created_at FROM (SELECT *, row_number() OVER
    (PARTITION BY transID ORDER BY ingest_seq) AS position FROM taps) WHERE position = 1""",
)
def dedup_first(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir).select("transID", "ingest_seq", "created_at")
    return dedup.first(rows, "transID", ARRIVAL)


@query(
    "dedup_sorted_first",
    """SELECT rider_id, birth_year, ingest_seq FROM (SELECT *, row_number() OVER
    (PARTITION BY rider_id ORDER BY birth_year ASC NULLS LAST, ingest_seq) AS position
    FROM p_clean) WHERE position = 1""",
)
def dedup_sorted_first(spark, sf_dir):
    rows = trips.clean_file_rows(testviews.taps(spark, sf_dir), ARRIVAL)
    order = [F.col("birth_year").asc_nulls_last(), F.col("ingest_seq")]
    return dedup.sorted_first(rows, "rider_id", order).select(
        "rider_id", "birth_year", "ingest_seq"
    )


@query(
    "dedup_lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (SELECT *, row_number() OVER
    (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey,
    l_extendedprice) AS position FROM lineitem) WHERE position = 1""",
)
def dedup_lineitem(spark, sf_dir):
    rows = testviews.table(spark, sf_dir, "lineitem")
    tie_break = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice")]
    kept = dedup.latest(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", tie_break=tie_break)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query("distinct_dates", "SELECT DISTINCT CAST(tapInTime AS DATE) AS travel_date FROM taps")
def distinct_dates(spark, sf_dir):
    days = testviews.taps(spark, sf_dir).select(F.to_date("tapInTime").alias("travel_date"))
    return dedup.distinct_values(days, "travel_date")


# ---------------------------------------------------------------------------------------- keys
@query(
    "dense_key",
    f"""SELECT l_orderkey, l_linenumber, copies,
    {numbered("l_orderkey, l_linenumber")} AS line_key FROM (SELECT l_orderkey, l_linenumber,
    count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def dense_key(spark, sf_dir):
    lines = testviews.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    counted = lines.agg(F.count(F.lit(1)).alias("copies"))
    return keys.dense_key(counted, "line_key", ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------------- the calendar
part(
    "p_spine",
    """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
    INTERVAL '1' DAY)) AS DATE) AS date FROM
    (SELECT date_trunc('day', o_orderdate) AS o_orderdate FROM orders)""",
)
CALENDAR = """CAST(year(date) AS SMALLINT) AS year, CAST(quarter(date) AS TINYINT) AS quarter,
    CAST(month(date) AS TINYINT) AS month, monthname(date) AS month_name,
    CAST(week(date) AS TINYINT) AS week_of_year, CAST(day(date) AS TINYINT) AS day_of_month,
    CAST(isodow(date) AS TINYINT) AS day_of_week, dayname(date) AS day_name,
    CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, 0 AS is_holiday,
    CAST(NULL AS VARCHAR) AS holiday_note"""


def _order_days(spark, sf_dir):
    day = F.to_date("o_orderdate")
    bounds = testviews.table(spark, sf_dir, "orders").agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date")
    )
    return dimensions.date_spine(bounds)


@query("date_spine", "SELECT date FROM p_spine")
def date_spine(spark, sf_dir):
    return _order_days(spark, sf_dir)


@query(
    "dim_date_spine",
    f"SELECT CAST({numbered('date')} AS INTEGER) AS date_key, date, {CALENDAR} FROM p_spine",
)
def dim_date_spine(spark, sf_dir):
    return dimensions.keyed_dimension(_order_days(spark, sf_dir), "date")


# ------------------------------------------------------------------- trips and their dimensions
part(
    "p_trips",
    f"""SELECT *, {FLEET_ID.format("route_id", "direction", "travel_date")} AS fleet_id,
    CAST(status = 'Sukses' AS INTEGER) AS is_success, CAST(status = 'Gratis' AS INTEGER) AS is_free
    FROM (SELECT *, CAST(tap_in_at AS DATE) AS travel_date,
      CAST(hour(tap_in_at) AS INTEGER) AS tap_in_hour, {DAY_PART.format("tap_in_at")} AS day_part,
      {DURATION.format("tap_in_at", "tap_out_at")} AS duration_min,
      {DURATION_HALF_EVEN.format("tap_in_at", "tap_out_at")} AS duration_half_even,
      {STATUS.format("tap_out_at", "paid")} AS status FROM p_clean)""",
)
part(
    "p_dim_date",
    f"""SELECT CAST({numbered("date")} AS INTEGER) AS date_key, date, {CALENDAR}
    FROM (SELECT DISTINCT travel_date AS date FROM p_trips)""",
)
part(
    "p_dim_stop",
    f"""SELECT {numbered("stop_id")} AS stop_key, stop_id, stop_name, latitude, longitude,
    {VALIDITY} FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY role, ingest_seq)
      AS position FROM (
      SELECT 0 AS role, board_stop_id AS stop_id, board_stop_name AS stop_name,
        board_lat AS latitude, board_lon AS longitude, ingest_seq FROM p_clean
      UNION ALL
      SELECT 1, alight_stop_id, alight_stop_name, alight_lat, alight_lon, ingest_seq
      FROM p_clean WHERE alight_stop_id IS NOT NULL)) WHERE position = 1""",
)
part(
    "p_dim_route",
    f"""SELECT {numbered("route_id")} AS route_key, route_id, route_name,
    {FIRST_ORIGIN.format("route_name")} AS origin,
    {FIRST_DESTINATION.format("route_name")} AS destination,
    {CORRIDOR_TYPE_OR_OTHER.format("route_id")} AS corridor_type, {VALIDITY}
    FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY ingest_seq) AS position
      FROM p_clean) WHERE position = 1""",
)
part(
    "p_dim_rider",
    f"""SELECT {numbered("rider_id")} AS rider_key, rider_id, rider_name, card_bank, gender,
    birth_year, age, {AGE_BAND_NULL_AWARE.format("age")} AS age_band,
    {SEGMENT_NULL_AWARE.format("age")} AS rider_segment, {VALIDITY}
    FROM (SELECT *, CAST(2023 - birth_year AS INTEGER) AS age, row_number() OVER (PARTITION BY
      rider_id ORDER BY birth_year ASC NULLS LAST, ingest_seq) AS position FROM p_clean)
    WHERE position = 1""",
)
part(
    "p_vehicles",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', CAST({c} AS SMALLINT))" for a, b, c in presets.VEHICLES)
    + ") AS v(corridor_type, vehicle_type, capacity)",
)
part(
    "p_dim_fleet",
    f"""SELECT {numbered("fleet_id")} AS fleet_key, fleet_id, route_id, direction,
    travel_date AS operating_date, vehicle_type, capacity, 1 AS is_synthetic,
    '{presets.FLEET_NOTE}' AS note
    FROM (SELECT *, {CORRIDOR_TYPE_OR_OTHER.format("route_id")} AS corridor_type, row_number()
      OVER (PARTITION BY fleet_id ORDER BY ingest_seq) AS position FROM p_trips)
    JOIN p_vehicles USING (corridor_type) WHERE position = 1""",
)


def _dimension(spark, sf_dir, name):
    trip_rows = derived(spark, sf_dir)
    return observed_dimensions(trip_rows, ARRIVAL, load_date(), names=[name])[name]


@query("dim_date_observed", "SELECT * FROM p_dim_date")
def dim_date_observed(spark, sf_dir):
    return _dimension(spark, sf_dir, "date")


@query("dim_stop_union", "SELECT * FROM p_dim_stop")
def dim_stop_union(spark, sf_dir):
    return _dimension(spark, sf_dir, "stop")


@query("dim_route", "SELECT * FROM p_dim_route")
def dim_route(spark, sf_dir):
    return _dimension(spark, sf_dir, "route")


@query("dim_rider", "SELECT * FROM p_dim_rider")
def dim_rider(spark, sf_dir):
    return _dimension(spark, sf_dir, "rider")


@query("dim_fleet", "SELECT * FROM p_dim_fleet")
def dim_fleet(spark, sf_dir):
    return _dimension(spark, sf_dir, "fleet")


@query(
    "fleet_load_summary",
    """SELECT count(DISTINCT fleet_id) AS vehicles, count(*) AS trips,
    round(count(*) / count(DISTINCT fleet_id), 1) AS trips_per_vehicle FROM p_trips""",
)
def fleet_load_summary(spark, sf_dir):
    return dimensions.fleet_load_summary(derived(spark, sf_dir))


# --------------------------------------------------------------- dimensions from source tables
part(
    "p_table_stop",
    f"""SELECT {numbered("stop_id")} AS stop_key, stop_id, trim(stop_name) AS stop_name, latitude,
    longitude, {VALIDITY} FROM stop_table""",
)
part(
    "p_table_route",
    f"""SELECT {numbered("route_id")} AS route_key, route_id, trim(route_name) AS route_name,
    trim(string_split(route_name, ' - ')[1]) AS origin,
    trim(string_split(route_name, ' - ')[2]) AS destination,
    {CORRIDOR_TYPE.format("route_id")} AS corridor_type, {VALIDITY} FROM route_table""",
)
part(
    "p_table_rider",
    f"""SELECT {numbered("rider_id")} AS rider_key, rider_id, rider_name, card_bank, gender,
    birth_year, age, {AGE_BAND_EXCLUSIVE.format("age")} AS age_band,
    {SEGMENT_EXCLUSIVE.format("age")} AS rider_segment, {VALIDITY}
    FROM (SELECT *, CAST(2023 - birth_year AS INTEGER) AS age FROM rider_table)""",
)


@query("dim_stop", "SELECT * FROM p_table_stop")
def dim_stop(spark, sf_dir):
    members = dimensions.table_stops(testviews.stop_table(spark, sf_dir))
    return dimensions.keyed_dimension(members, "stop", load_date())


@query("dim_route_table", "SELECT * FROM p_table_route")
def dim_route_table(spark, sf_dir):
    members = dimensions.table_routes(testviews.route_table(spark, sf_dir))
    return dimensions.keyed_dimension(members, "route", load_date())


@query("dim_rider_table", "SELECT * FROM p_table_rider")
def dim_rider_table(spark, sf_dir):
    people = dimensions.with_age(
        testviews.rider_table(spark, sf_dir),
        presets.REFERENCE_YEAR,
        presets.AGE_BANDS_EXCLUSIVE,
        presets.SEGMENTS_EXCLUSIVE,
    )
    return dimensions.keyed_dimension(people, "rider", load_date())


part(
    "p_categories",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({k}, '{n}', '{d}')" for k, n, d in presets.FEEDBACK_CATEGORIES)
    + ") AS c(feedback_category_key, category_name, description)",
)


@query(
    "dim_feedback_category",
    """SELECT feedback_category_key, category_name, description, count(trip_id) AS feedback_rows
    FROM p_categories LEFT JOIN feedback_table ON category = category_name
    GROUP BY ALL""",
)
def dim_feedback_category(spark, sf_dir):
    """The fixed categories with the number of feedback rows in each."""
    counts = testviews.feedback_table(spark, sf_dir).groupBy("category").agg(
        F.count(F.lit(1)).alias("feedback_rows")
    )
    categories = dimensions.dim_feedback_category(spark)
    joined = categories.join(counts, categories["category_name"] == counts["category"], "left")
    return joined.drop("category").fillna(0, subset=["feedback_rows"])


part(
    "p_unknown_stop",
    """SELECT * FROM p_dim_stop UNION ALL SELECT -1, 'UNKNOWN', 'Halte Tidak Diketahui',
    0, 0, DATE '1900-01-01', NULL, 1""",
)
part(
    "p_unknown_date",
    """SELECT * FROM p_dim_date UNION ALL SELECT -1, DATE '1900-01-01', 1900, 1, 1, 'Unknown', 1, 1,
    1, 'Unknown', 0, 0, NULL""",
)
part(
    "p_unknown_route",
    """SELECT * REPLACE (row_number() OVER (ORDER BY route_id) AS route_key) FROM p_dim_route
    WHERE route_id <> 'UNKNOWN'
    UNION ALL SELECT -1, 'UNKNOWN', 'Rute Tidak Diketahui', NULL, NULL,
    'Unknown', DATE '1900-01-01', NULL, 1""",
)
part(
    "p_unknown_rider",
    """SELECT * FROM p_dim_rider UNION ALL SELECT -1, -1, 'Tidak Diketahui', 'Unknown', 'U', NULL,
    NULL, 'Unknown', 'Unknown', DATE '1900-01-01', NULL, 1""",
)
part(
    "p_unknown_fleet",
    """SELECT * FROM p_dim_fleet UNION ALL SELECT -1, 'UNKNOWN', 'UNKNOWN', 0, DATE '1900-01-01',
    'Unknown', 0, 1, NULL""",
)
MEMBERS = {
    "date": ("date_key", "CAST(date AS VARCHAR)", "day_name"),
    "stop": ("stop_key", "stop_id", "stop_name"),
    "route": ("route_key", "route_id", "corridor_type"),
    "rider": ("rider_key", "CAST(rider_id AS VARCHAR)", "rider_segment"),
    "fleet": ("fleet_key", "fleet_id", "vehicle_type"),
}


@query(
    "unknown_member",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS dimension, CAST({key} AS BIGINT) AS member_key, {natural} AS member,
        {label} AS label FROM p_unknown_{name}"""
        for name, (key, natural, label) in MEMBERS.items()
    ),
)
def unknown_member(spark, sf_dir):
    """Every member of every dimension; seeding the unknown one twice adds it once."""
    built = observed_dimensions(staged(spark, sf_dir), ARRIVAL, load_date(), unknown=True)
    result = None
    for name, (key, natural, label) in MEMBERS.items():
        seeded = dimensions.with_unknown(built[name], name)
        members = seeded.select(
            F.lit(name).alias("dimension"),
            F.col(key).cast("bigint").alias("member_key"),
            F.expr(natural.replace("VARCHAR", "STRING")).alias("member"),
            F.col(label).alias("label"),
        )
        result = members if result is None else result.unionByName(members)
    return result
