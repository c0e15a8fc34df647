"""Facts and load semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.operators import checks, cleaning, dedup, dimensions, facts, loading
from tapmart.operators import trips as trip_rows
from tapmart.plans.from_files import observed_dimensions, star_from_files, strict_star_from_files
from tapmart.plans.from_tables import full_fact, strict_fact, table_dimensions
from tapmart.presets import REFERENCE_YEAR
from tapmart.queries.cleaning import BANKS
from tapmart.queries.derive import DAY_PART, DURATION, FLEET_ID, STATUS
from tapmart.queries.dimensions import ARRIVAL, derived, load_date, staged
from tapmart.queries.registry import part, query

BATCH = "batch-1"
TIE_BREAK = ("ingest_seq",)


# -------------------------------------------------------------------------- from source tables
part(
    "p_table_date",
    """SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS date_key, date FROM
    (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL '1' DAY)) AS DATE) AS date
    FROM (SELECT date_trunc('day', ts) AS day FROM events))""",
)
part(
    "p_feedback",
    """SELECT trip_id, rating, comment, feedback_category_key FROM (SELECT *, row_number() OVER
    (PARTITION BY trip_id ORDER BY created_at DESC, ingest_seq) AS position FROM feedback_table)
    LEFT JOIN p_categories ON category = category_name WHERE position = 1""",
)
part(
    "p_newest",
    """SELECT * EXCLUDE position FROM (SELECT *, row_number() OVER (PARTITION BY trip_id
    ORDER BY created_at DESC, ingest_seq) AS position FROM trip_table) WHERE position = 1""",
)
_TIMES = f"""CAST(hour(tap_in_at) AS INTEGER) AS tap_in_hour,
    {DAY_PART.format("tap_in_at")} AS day_part,
    {DURATION.format("tap_in_at", "tap_out_at")} AS duration_min"""
part(
    "p_fact_full",
    f"""SELECT coalesce(d.date_key, -1) AS date_key, coalesce(b.stop_key, -1) AS board_stop_key,
      coalesce(a.stop_key, -1) AS alight_stop_key, coalesce(r.route_key, -1) AS route_key,
      coalesce(p.rider_key, -1) AS rider_key,
      coalesce(f.feedback_category_key, -1) AS feedback_category_key,
      coalesce(v.fleet_key, -1) AS fleet_key, t.trip_id, t.fleet_id, tap_in_at, tap_out_at,
      {_TIMES}, paid, paid AS fare, CAST(0 AS DECIMAL(10,2)) AS discount,
      CAST(NULL AS DECIMAL(5,2)) AS distance_km, t.direction, board_seq, alight_seq, p.card_bank,
      CAST(NULL AS VARCHAR) AS pay_method, t.status, CAST(t.status = 'Sukses' AS INTEGER)
      AS is_success, CAST(t.status = 'Gratis' AS INTEGER) AS is_free, f.rating, f.comment,
      CAST(f.rating IS NOT NULL AS INTEGER) AS has_feedback, 'postgresql' AS source,
      '{BATCH}' AS batch_id
    FROM (SELECT * REPLACE (coalesce(alight_stop_id, 'UNKNOWN') AS alight_stop_id,
        CASE WHEN status LIKE 'Inkompl%' THEN 'Incomplete' ELSE status END AS status),
        {FLEET_ID.format("coalesce(route_id, 'UNKNOWN')", "direction", "tap_in_at")} AS fleet_id
      FROM p_newest) t
    LEFT JOIN p_table_date d ON d.date = CAST(t.tap_in_at AS DATE)
    LEFT JOIN p_table_stop b ON b.stop_id = t.board_stop_id
    LEFT JOIN p_table_stop a ON a.stop_id = t.alight_stop_id
    LEFT JOIN p_table_route r ON r.route_id = t.route_id
    LEFT JOIN p_table_rider p ON p.rider_id = t.rider_id
    LEFT JOIN p_dim_fleet v ON v.fleet_id = t.fleet_id
    LEFT JOIN p_feedback f ON f.trip_id = t.trip_id""",
)


def source_tables(spark, sf_dir):
    return {
        "trips": testviews.trip_table(spark, sf_dir),
        "riders": testviews.rider_table(spark, sf_dir),
        "stops": testviews.stop_table(spark, sf_dir),
        "routes": testviews.route_table(spark, sf_dir),
        "feedback": testviews.feedback_table(spark, sf_dir),
    }


def calendar_days(spark, sf_dir):
    day = F.to_date("ts")
    bounds = testviews.table(spark, sf_dir, "events").agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date")
    )
    return dimensions.date_spine(bounds)


def _table_star(spark, sf_dir, tables):
    return table_dimensions(tables, calendar_days(spark, sf_dir), load_date(), REFERENCE_YEAR)


@query("fact_full", "SELECT * FROM p_fact_full")
def fact_full(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    route = F.coalesce("route_id", F.lit("UNKNOWN"))
    fleet_id = trip_rows.routes.fleet_id(route, F.col("direction"), F.to_date("tap_in_at"))
    tables["trips"] = tables["trips"].withColumn("fleet_id", fleet_id)
    star = _table_star(spark, sf_dir, tables)
    vehicles = dimensions.fleet_members(derived(spark, sf_dir), ARRIVAL)
    fleet = dimensions.keyed_dimension(vehicles, "fleet")
    star["fleet"] = dimensions.add_unknown(fleet, "fleet")
    return full_fact(tables, star, "postgresql", BATCH, TIE_BREAK)


part(
    "p_fact_without_fleet",
    """SELECT * REPLACE (CAST(-1 AS BIGINT) AS fleet_key, 'UNKNOWN' AS fleet_id)
    FROM p_fact_full""",
)


@query("fact_without_fleet", "SELECT * FROM p_fact_without_fleet")
def fact_without_fleet(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return full_fact(tables, _table_star(spark, sf_dir, tables), "postgresql", BATCH, TIE_BREAK)


part(
    "p_fact_strict",
    f"""SELECT d.date_key, b.stop_key AS board_stop_key, a.stop_key AS alight_stop_key,
      r.route_key, p.rider_key, t.trip_id, tap_in_at, tap_out_at, {_TIMES}, paid, t.direction,
      board_seq, alight_seq, p.card_bank, new_status AS status,
      CAST(new_status = 'Sukses' AS INTEGER) AS is_success,
      CAST(new_status = 'Gratis' AS INTEGER) AS is_free, 'postgresql' AS source,
      '{BATCH}' AS batch_id
    FROM (SELECT *, {STATUS.format("tap_out_at", "paid")} AS new_status, row_number() OVER
        (PARTITION BY trip_id ORDER BY created_at DESC, ingest_seq) AS position
      FROM trip_table WHERE status IN ('Sukses', 'Gratis')) t
    JOIN p_table_date d ON d.date = CAST(t.tap_in_at AS DATE)
    JOIN p_table_stop b ON b.stop_id = t.board_stop_id
    JOIN p_table_rider p ON p.rider_id = t.rider_id
    LEFT JOIN p_table_stop a ON a.stop_id = t.alight_stop_id
    LEFT JOIN p_table_route r ON r.route_id = t.route_id
    WHERE position = 1""",
)


@query("fact_strict", "SELECT * FROM p_fact_strict")
def fact_strict(spark, sf_dir):
    tables = source_tables(spark, sf_dir)
    return strict_fact(tables, _table_star(spark, sf_dir, tables), "postgresql", BATCH, TIE_BREAK)


@query(
    "feedback_category_prejoin",
    "SELECT trip_id, rating, comment, feedback_category_key FROM p_feedback",
)
def feedback_category_prejoin(spark, sf_dir):
    feedback = testviews.feedback_table(spark, sf_dir)
    return facts.feedback_with_category(
        feedback, dimensions.dim_feedback_category(spark), TIE_BREAK
    )


@query(
    "role_playing_join",
    """SELECT trip_id, t.ingest_seq, b.stop_name AS board_stop_name, a.stop_name AS alight_stop_name
    FROM trip_table t LEFT JOIN p_table_stop b ON b.stop_id = t.board_stop_id
    LEFT JOIN p_table_stop a ON a.stop_id = t.alight_stop_id""",
)
def role_playing_join(spark, sf_dir):
    members = dimensions.table_stops(testviews.stop_table(spark, sf_dir))
    stops = dimensions.keyed_dimension(members, "stop", load_date())
    board = cleaning.prefix_columns(stops, "board_dim_")
    alight = cleaning.prefix_columns(stops, "alight_dim_")
    rows = testviews.trip_table(spark, sf_dir)
    return (
        rows.join(board, F.col("board_stop_id") == F.col("board_dim_stop_id"), "left")
        .join(alight, F.col("alight_stop_id") == F.col("alight_dim_stop_id"), "left")
        .select(
            "trip_id",
            "ingest_seq",
            F.col("board_dim_stop_name").alias("board_stop_name"),
            F.col("alight_dim_stop_name").alias("alight_stop_name"),
        )
    )


# ------------------------------------------------------------------------------ from flat files
_FLAT_COLUMNS = f"""t.trip_id, t.fleet_id, tap_in_at, tap_out_at, tap_in_hour, day_part, paid,
    CAST(NULL AS DECIMAL(10,2)) AS fare, CAST(NULL AS DECIMAL(10,2)) AS discount,
    CAST(NULL AS DECIMAL(5,2)) AS distance_km, t.direction, board_seq, alight_seq, p.card_bank,
    CAST(NULL AS VARCHAR) AS pay_method, status, is_success, is_free,
    CAST(NULL AS SMALLINT) AS rating, CAST(NULL AS VARCHAR) AS comment, 0 AS has_feedback,
    'csv' AS source, '{BATCH}' AS batch_id, -1 AS feedback_category_key"""
_FLAT_KEYS = """d.date_key, b.stop_key AS board_stop_key,
    coalesce(a.stop_key, -1) AS alight_stop_key, coalesce(r.route_key, -1) AS route_key,
    p.rider_key, coalesce(v.fleet_key, -1) AS fleet_key"""
_FLAT_JOINS = """JOIN p_dim_date d ON d.date = t.travel_date
    JOIN p_dim_stop b ON b.stop_id = t.board_stop_id
    JOIN p_dim_rider p ON p.rider_id = t.rider_id
    LEFT JOIN p_dim_stop a ON a.stop_id = t.alight_stop_id
    LEFT JOIN p_dim_route r ON r.route_id = t.route_id
    LEFT JOIN p_dim_fleet v ON v.fleet_id = t.fleet_id"""
# The reports' fact: the unknown member stands for routes without an id.
part(
    "p_fact",
    f"""SELECT {_FLAT_KEYS}, duration_min, {_FLAT_COLUMNS} FROM p_trips t
    {_FLAT_JOINS.replace("p_dim_route", "p_unknown_route")}""",
)
part(
    "p_fact_flat",
    f"""SELECT {_FLAT_KEYS}, duration_half_even AS duration_min, {_FLAT_COLUMNS}
    FROM p_trips t {_FLAT_JOINS}""",
)


def star(spark, sf_dir, *names):
    """The star schema the reports run on, with the dimensions they need."""
    return star_from_files(
        testviews.taps(spark, sf_dir), ARRIVAL, load_date(), "csv", BATCH, names=names
    )


@query("fact_from_flat", "SELECT * FROM p_fact_flat")
def fact_from_flat(spark, sf_dir):
    rows = testviews.taps(spark, sf_dir)
    return strict_star_from_files(rows, ARRIVAL, load_date(), "csv", BATCH)["fact"]


# ------------------------------------------------------------------------------ load semantics
# The stored state is what a first batch left behind: trips of the first half of January, of part
# of the riders. The new batch is everything.
SPLIT_DAY = "2024-01-16"
part(
    "p_stored",
    f"SELECT * FROM p_trips WHERE travel_date < DATE '{SPLIT_DAY}' AND rider_id % 7 <> 3",
)
part(
    "p_stored_rider",
    """SELECT row_number() OVER (ORDER BY rider_id) AS rider_key, rider_id FROM
    (SELECT DISTINCT rider_id FROM p_stored)""",
)
part(
    "p_stored_fleet",
    """SELECT row_number() OVER (ORDER BY fleet_id) AS fleet_key, fleet_id FROM
    (SELECT DISTINCT fleet_id FROM p_stored)""",
)
part(
    "p_synced_fleet",
    """SELECT fleet_key, fleet_id FROM p_stored_fleet UNION ALL
    SELECT (SELECT coalesce(max(fleet_key), 0) FROM p_stored_fleet)
      + row_number() OVER (ORDER BY fleet_id), fleet_id FROM (SELECT DISTINCT fleet_id FROM p_trips
    WHERE fleet_id NOT IN (SELECT fleet_id FROM p_stored_fleet))""",
)


def _stored(rows):
    return rows.where((F.col("travel_date") < F.lit(SPLIT_DAY).cast("date")) & F.expr("rider_id % 7 <> 3"))


@query(
    "dim_insert_only",
    """SELECT (SELECT coalesce(max(rider_key), 0) FROM p_stored_rider)
      + row_number() OVER (ORDER BY rider_id) AS rider_key, rider_id, rider_name, card_bank
    FROM p_dim_rider WHERE rider_id NOT IN (SELECT rider_id FROM p_stored_rider)""",
)
def dim_insert_only(spark, sf_dir):
    """The riders of the new batch that the stored dimension, unknown member included, lacks."""
    rows = staged(spark, sf_dir)
    names = ["rider"]
    stored = observed_dimensions(_stored(rows), ARRIVAL, load_date(), names=names, unknown=True)
    members = dimensions.rider_members(rows, ARRIVAL, REFERENCE_YEAR)
    added = dimensions.added_members(members, stored["rider"], "rider", load_date())
    return added.select("rider_key", "rider_id", "rider_name", "card_bank")


@query(
    "fact_skip_existing",
    """SELECT trip_id, travel_date, paid, status FROM p_trips
    WHERE trip_id NOT IN (SELECT trip_id FROM p_stored)""",
)
def fact_skip_existing(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return loading.skip_existing(rows, _stored(rows)).select(
        "trip_id", "travel_date", "paid", "status"
    )


_FLEET_KEY = ("trip_id", "fleet_key")


@query(
    "fact_key_resync",
    """SELECT t.trip_id, v.fleet_key, n.fleet_key AS provisional_fleet_key FROM p_trips t
    JOIN p_synced_fleet v ON v.fleet_id = t.fleet_id
    JOIN p_dim_fleet n ON n.fleet_id = t.fleet_id""",
)
def fact_key_resync(spark, sf_dir):
    """Fleet keys as the batch alone would give them, and as the stored dimension gives them."""
    rows = staged(spark, sf_dir)
    earlier = dimensions.fleet_members(_stored(rows), ARRIVAL)
    stored = dimensions.keyed_dimension(earlier, "fleet")
    members = dimensions.fleet_members(rows, ARRIVAL)
    synced = stored.unionByName(dimensions.added_members(members, stored, "fleet"))
    provisional = dimensions.keyed_dimension(members, "fleet")
    policy = {"fleet": "unknown"}
    before = facts.build_fact(rows, {"fleet": provisional}, policy, "csv", BATCH, columns=_FLEET_KEY)
    after = loading.resync_fact(rows, {"fleet": synced}, "csv", BATCH).select(*_FLEET_KEY)
    before = before.withColumnRenamed("fleet_key", "provisional_fleet_key")
    return after.join(before, "trip_id")


@query(
    "lookup_miss_report",
    """SELECT 'board_stop' AS look_up, CAST(count(*) AS BIGINT) AS missed FROM p_newest
      WHERE board_stop_id IS NULL OR board_stop_id NOT IN (SELECT stop_id FROM stop_table)
    UNION ALL SELECT 'route', count(*) FROM p_newest
      WHERE route_id IS NULL OR route_id NOT IN (SELECT route_id FROM route_table)
    UNION ALL SELECT 'rider', count(*) FROM p_newest
      WHERE rider_id IS NULL OR rider_id NOT IN (SELECT rider_id FROM rider_table)""",
)
def lookup_miss_report(spark, sf_dir):
    newest = dedup.latest(
        testviews.trip_table(spark, sf_dir), "trip_id", tie_break=[F.col("ingest_seq")]
    )
    members = {
        "stop": testviews.stop_table(spark, sf_dir),
        "route": testviews.route_table(spark, sf_dir),
        "rider": testviews.rider_table(spark, sf_dir),
    }
    return facts.lookup_misses(newest, members, ["board_stop", "route", "rider"])


# --------------------------------------------------------------------------------------- checks
@query(
    "check_unique_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def check_unique_keys(spark, sf_dir):
    lines = testviews.table(spark, sf_dir, "lineitem")
    return checks.duplicate_keys(lines, "l_orderkey", "l_linenumber")


@query(
    "check_foreign_keys",
    """SELECT board_stop_id, count(*) AS rows FROM trip_table WHERE board_stop_id IS NULL
    OR board_stop_id NOT IN (SELECT stop_id FROM stop_table) GROUP BY board_stop_id""",
)
def check_foreign_keys(spark, sf_dir):
    rows = testviews.trip_table(spark, sf_dir)
    return checks.dangling_keys(
        rows, "board_stop_id", testviews.stop_table(spark, sf_dir), "stop_id"
    )


@query(
    "check_allowed_values",
    f"""SELECT payCardBank, count(*) AS rows FROM taps WHERE payCardBank IS NULL
    OR payCardBank NOT IN ({BANKS}) GROUP BY payCardBank""",
)
def check_allowed_values(spark, sf_dir):
    return checks.values_outside(
        testviews.taps(spark, sf_dir), "payCardBank", presets.CARD_BANKS
    )
