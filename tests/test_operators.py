"""Operators on small frames, with ties, nulls, empty input and hot keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.operators import cleaning, dedup, dimensions, facts, keys, loading, olap, shaping
from tapmart.operators.lookups import look_up
from tapmart.operators.reporting import observed
from tapmart.operators.trips import (
    BAD_AMOUNT,
    clean_file_rows,
    complete_trips,
    judged_file_rows,
)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def file_rows(spark, *rows):
    """Rows of a flat file, all texts; columns not given get plain defaults."""
    plain = {
        "transID": "T1",
        "payCardID": "7",
        "payCardBank": "dki",
        "payCardName": "Name",
        "payCardSex": "M",
        "payCardBirthDate": "1990",
        "tapInStops": "P1",
        "tapInStopsName": "Stop 1",
        "tapInStopsLat": "-6.2",
        "tapInStopsLon": "106.8",
        "tapInTime": "2023-04-03 07:00:00",
        "tapOutTime": "2023-04-03 07:30:00",
        "tapOutStops": "P2",
        "tapOutStopsName": "Stop 2",
        "tapOutStopsLat": "-6.3",
        "tapOutStopsLon": "106.9",
        "payAmount": "3500",
        "corridorID": "5",
        "corridorName": "A - B",
        "direction": "0",
    }
    schema = ", ".join(f"{name} string" for name in plain) + ", seq bigint"
    data = [tuple({**plain, **row}.values()) + (n,) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, schema)


# ------------------------------------------------------------------------------------- cleaning
def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="tapInTime"):
        cleaning.require_columns(spark.range(1), ["id", "tapInTime"])


def test_strip_headers(spark):
    assert cleaning.strip_headers(spark.range(1).toDF(" trans ID ")).columns == ["transID"]


def test_cleaning_keeps_the_first_row_before_it_checks_times(spark):
    rows = file_rows(
        spark,
        {"tapInTime": "no time"},
        {},
        {"transID": "T2", "tapOutTime": None, "payAmount": "free", "corridorID": "nan"},
        {"transID": "nan"},
        {"transID": "T3", "tapInStops": None},
    )
    cleaned = clean_file_rows(rows, ["seq"]).select("trip_id", "paid", "route_id", "tap_out_at")
    # T1 is lost with its first row; the others lack a trip id or a stop.
    assert [(r[0], int(r[1]), r[2], r[3]) for r in cleaned.collect()] == [("T2", 0, "UNKNOWN", None)]


def test_absent_optional_columns(spark):
    rows = file_rows(spark, {}).select(*presets.REQUIRED_FILE_COLUMNS, "seq")
    row = clean_file_rows(rows, ["seq"]).first()
    assert (row["direction"], row["route_id"], row["paid"]) == (0, "UNKNOWN", 0)
    assert (row["tap_out_at"], row["birth_year"], row["board_seq"]) == (None, None, None)


def test_amounts_too_large_are_rejected_not_zero(spark):
    rows = file_rows(spark, {"payAmount": "1e12"})
    (judged,) = judged_file_rows(rows, ["seq"]).collect()
    assert judged["paid"] is None and judged["reject_reason"] == BAD_AMOUNT


def test_complete_trips(spark):
    trips = spark.createDataFrame(
        [("T1", datetime(2024, 5, 1), None, 5), ("T2", None, None, 5)],
        "trip_id string, tap_in_at timestamp_ntz, alight_stop_id string, paid int",
    )
    (row,) = complete_trips(trips).collect()
    assert (row["alight_stop_id"], row["fleet_id"], row["fare"]) == ("UNKNOWN", "UNKNOWN", 5)


def test_observed_rows_are_counted_on_the_way(spark):
    counted, observation = observed(spark.range(10), "ten", big=F.count_if(F.col("id") > 6))
    counted.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 10, "big": 3}


# ------------------------------------------------------------------------------------------ dedup
def test_latest_with_ties_and_without_its_column(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4)], "k string, created_at int, n int"
    )
    kept = dedup.latest(rows, "k", tie_break=[F.col("n").desc()])
    assert rows_of(kept.select("k", "n")) == [("a", 3), ("b", 4)]
    by_tap = rows.withColumnRenamed("created_at", "tap_in_at")
    kept = dedup.latest(by_tap, "k", tie_break=[F.col("n")])
    assert rows_of(kept.select("k", "n")) == [("a", 2), ("b", 4)]


def test_dedup_is_idempotent(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"))
    once = dedup.first(rows, "k", ["n"])
    assert rows_of(dedup.first(once, "k", ["n"])) == rows_of(once)


def test_dedup_limits_groups_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("n"))
    plan = dedup.first(rows, "k", ["n"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_first_version_prefers_then_takes_the_first(spark):
    rows = spark.createDataFrame(
        [
            ("r", "old", None, "f1", 0, 1),
            ("r", "b", 1990, "f2", 0, 0),
            ("r", "a", 1980, "f2", 0, 1),
            ("s", "x", None, "f1", 0, 0),
            ("s", "y", None, "f1", 0, 2),
        ],
        "k string, name string, year int, file string, block int, row int",
    )
    arrival = ["file", "block", "row"]
    nulls_last = [F.col("year").asc_nulls_last()]
    kept = dedup.first_version(rows, "k", ["name", "year"], arrival, nulls_last)
    assert rows_of(kept.select("k", "name")) == [("r", "a"), ("s", "x")]
    by_file = dedup.first_version(rows, "k", ["name", "year"], arrival, nulls_last, "file")
    assert rows_of(by_file.select("k", "name")) == [("r", "old"), ("s", "x")]


# ------------------------------------------------------------------------------------------- keys
@pytest.mark.parametrize("size", [0, 1, 5000])
def test_dense_keys_have_no_gaps_in_either_form(spark, size):
    names = spark.range(size).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    by_window = rows_of(keys.dense_key(names, "key", ["name"], bounded=True))
    by_ranges = rows_of(keys.dense_key(names.repartition(13), "key", ["name"]))
    assert by_ranges == by_window
    assert [key for _, key in sorted(by_ranges)] == list(range(1, size + 1))


def test_dense_key_starts_anywhere(spark):
    found = keys.dense_key(spark.range(3), "key", ["id"], start=10)
    assert rows_of(found) == [(0, 10), (1, 11), (2, 12)]


def test_appended_keys_go_on_after_the_stored_ones(spark):
    stored = spark.createDataFrame([(-1, "UNKNOWN"), (1, "b"), (7, "d")], "key bigint, name string")
    fresh = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert rows_of(keys.append_keys(fresh, stored, "key", "name").select("key", "name")) == [
        (8, "a"),
        (9, "c"),
    ]
    only_unknown = stored.where("key = -1")
    added = keys.append_keys(fresh, only_unknown, "key", "name").select("key", "name")
    assert rows_of(added) == [(1, "a"), (2, "b"), (3, "c")]


# ------------------------------------------------------------------------------------- dimensions
def test_boarding_stops_win_over_alighting_stops(spark):
    trips = clean_file_rows(
        file_rows(
            spark,
            {"tapOutStops": "P9", "tapOutStopsName": "From tap-out"},
            {"transID": "T2", "tapInStops": "P9", "tapInStopsName": "From tap-in"},
            {"transID": "T3", "tapOutStops": None, "tapOutStopsName": "No stop"},
        ),
        ["seq"],
    )
    stops = dimensions.stop_members(trips, ["seq"]).select("stop_id", "stop_name")
    assert rows_of(stops) == [
        ("P1", "Stop 1"),
        ("P2", "Stop 2"),
        ("P9", "From tap-in"),
    ]


def test_unknown_members_fit_their_dimensions_and_are_seeded_once(spark):
    for name in dimensions.LAYOUTS:
        schema = dimensions.dimension_schema(name)
        empty = spark.createDataFrame([], schema)
        seeded = dimensions.with_unknown(dimensions.with_unknown(empty, name), name)
        (row,) = seeded.collect()
        assert row[f"{name}_key"] == -1
        assert row[dimensions.NATURAL_KEYS[name]] is not None


def test_rows_that_carry_the_unknown_id_do_not_become_a_second_member(spark):
    members = spark.createDataFrame([("UNKNOWN",), ("5",)], "route_id string")
    assert rows_of(dimensions.without_unknown(members, "route")) == [("5",)]


def test_vehicles_of_unlisted_types_are_other(spark):
    types = spark.createDataFrame([("Mikrotrans",), ("Ferry",)], "corridor_type string")
    found = dimensions.with_vehicle(types).select("corridor_type", "vehicle_type", "capacity")
    assert rows_of(found) == [("Ferry", "Bus Umum", 60), ("Mikrotrans", "Angkot/Van", 14)]


def test_fixed_spine(spark):
    bounds = dimensions.fixed_bounds(spark, "2023-04-01", "2023-04-30")
    dim = dimensions.keyed_dimension(dimensions.date_spine(bounds), "date")
    days = dim.orderBy("date_key").collect()
    assert len(days) == 30
    assert (days[0]["date_key"], days[0]["date"], days[0]["day_name"]) == (
        1,
        date(2023, 4, 1),
        "Saturday",
    )


# ------------------------------------------------------------------------------- look-ups and facts
def test_miss_policies(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "n int, stop string")
    dim = spark.createDataFrame(
        [(10, "a", 1), (11, "a", 0)], "stop_key int, stop_id string, is_current int"
    )
    take = {"stop_key": "key"}

    def found(miss):
        return rows_of(look_up(rows, dim, ("stop", "stop_id"), take, miss).select("n", "key"))

    assert found("unknown") == [(1, 10), (2, -1), (3, -1)]
    assert found("null") == [(1, 10), (2, None), (3, None)]
    assert found("drop") == [(1, 10)]


def test_feedback_given_twice_does_not_multiply_trips(spark):
    feedback = spark.createDataFrame(
        [("T1", 3, "x", "Umum", 1), ("T1", 5, "y", "Saran", 2)],
        "trip_id string, rating int, comment string, category string, created_at int",
    )
    categories = dimensions.dim_feedback_category(spark)
    found = facts.feedback_with_category(feedback, categories)
    assert rows_of(found) == [("T1", 5, "y", None)]
    without = facts.feedback_with_category(feedback.drop("category"), categories)
    assert rows_of(without) == [("T1", 5, "y", None)]


def test_feedback_join_moves_no_trip_that_was_just_deduplicated(spark):
    trips = spark.createDataFrame([("T1", 1)], "trip_id string, created_at int")
    feedback = spark.createDataFrame(
        [("T1", 3, "x", 1)], "trip_id string, rating int, comment string, created_at int"
    )
    side = facts.feedback_with_category(feedback, dimensions.dim_feedback_category(spark))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.build_fact(
            dedup.latest(trips, "trip_id"),
            {},
            {},
            "csv",
            "b",
            feedback=side,
            columns=["trip_id", "rating", "has_feedback"],
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # one per input, for its own dedup
        assert rows_of(joined) == [("T1", 3, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_of_large_dimensions_are_split(spark):
    """A key with a third of all rows, and as many nulls, joined to a dimension too large to
    broadcast: the run-time plan splits them, and no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        third = F.col("id") % 3
        rows = spark.range(0, 300_000, 1, 16).select(
            F.when(third == 0, F.lit(7)).when(third == 1, F.col("id")).alias("card"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dim = spark.range(0, 300_000).select(
            F.col("id").alias("rider_id"), (F.col("id") + 1).alias("rider_key")
        )
        found = look_up(rows, dim, ("card", "rider_id"), {"rider_key": "rider_key"})
        result = found.select("rider_key", "payload").groupBy("rider_key")
        joined = found.select("rider_key", F.length("payload").alias("size"))
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        counts = dict(
            (r[0], r[1]) for r in result.count().where("rider_key IN (-1, 8)").collect()
        )
        assert counts == {8: 100_001, -1: 100_000} or counts == {8: 100_000, -1: 100_000}
        assert found.count() == 300_000
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_skip_existing(spark):
    stored = spark.createDataFrame([("T1",), ("T2",)], "trip_id string")
    batch = spark.createDataFrame([("T2", 1), ("T3", 2)], "trip_id string, n int")
    assert rows_of(loading.skip_existing(batch, stored)) == [("T3", 2)]


def test_a_small_batch_does_not_shuffle_the_stored_facts(spark, folder):
    spark.range(200_000).select(F.concat(F.lit("T"), "id").alias("trip_id")).write.parquet(
        folder + "/stored"
    )
    spark.range(50).select(F.concat(F.lit("T"), "id").alias("trip_id")).write.parquet(
        folder + "/batch"
    )
    stored, batch = (spark.read.parquet(f"{folder}/{n}") for n in ("stored", "batch"))
    fresh = loading.skip_existing(batch, stored)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert fresh.count() == 0


# -------------------------------------------------------------------------------- reports, layouts
def _fact(spark, rows):
    schema = (
        "date_key int, board_stop_key bigint, rider_key bigint, status string, is_success int, "
        "is_free int, paid decimal(10,2), duration_min smallint, tap_in_hour int, "
        "day_part string, direction smallint"
    )
    return spark.createDataFrame(rows, schema)


def _trip(stop=1, paid=3500, status="Sukses", date_key=1, rider=1, hour=7, direction=0):
    from decimal import Decimal

    return (
        date_key, stop, rider, status, int(status == "Sukses"), int(status == "Gratis"),
        Decimal(paid), 30, hour, "Pagi", direction,
    )


def test_top_stops_keep_all_that_share_the_last_rank(spark):
    stops = spark.createDataFrame(
        [(k, f"P{k}", f"Stop {k}") for k in range(1, 5)],
        "stop_key bigint, stop_id string, stop_name string",
    )
    incomplete = presets.STATUS_INCOMPLETE
    trips = [_trip(1)] * 3 + [_trip(2), _trip(2, status=incomplete)] + [_trip(3)] * 2 + [_trip(4)]
    top = olap.top_stops(_fact(spark, trips), stops, top=2).collect()
    assert [(r["stop_id"], r["ranking"], r["pct_incomplete"]) for r in top] == [
        ("P1", 1, 0.0),
        ("P2", 2, 50.0),
        ("P3", 2, 0.0),
    ]
    top = olap.top_stops(_fact(spark, trips), stops, top=3)
    assert [r["ranking"] for r in top.collect()] == [1, 2, 2]


def test_the_unknown_date_counts_as_a_working_day_unless_left_out(spark):
    days = dimensions.unknown_row(spark, "date", dimensions.dimension_schema("date"))
    fact = _fact(spark, [_trip(date_key=-1)])
    assert olap.hour_direction(fact, days).count() == 1
    assert olap.hour_direction(fact, days, include_unknown=False).count() == 0
    assert olap.daily_trend(fact, days).first()["date"] == date(1900, 1, 1)


def test_reports_of_no_facts_are_empty(spark):
    days = spark.createDataFrame([], dimensions.dimension_schema("date"))
    riders = spark.createDataFrame([], dimensions.dimension_schema("rider"))
    fact = _fact(spark, [])
    assert olap.daily_trend(fact, days).count() == 0
    assert olap.rider_profile(fact, riders).count() == 0
    grid = shaping.hourly_grid(olap.hour_direction(fact, days)).collect()
    assert len(grid) == 48 and {r["trips"] for r in grid} == {0}


def test_shares_sum_to_a_hundred(spark):
    report = spark.createDataFrame([("dki", 3), ("bni", 1)], "card_bank string, trips bigint")
    shares = shaping.share_by_bank(report).collect()
    assert [(r["card_bank"], r["pct"]) for r in shares] == [("bni", 25.0), ("dki", 75.0)]


def test_pivot_fills_what_is_absent(spark):
    report = spark.createDataFrame(
        [("BRT Utama", "dki", 3), ("Mikrotrans", "bni", 2)],
        "corridor_type string, card_bank string, trips bigint",
    )
    first, second = shaping.pivot_corridor_bank(report).collect()
    assert (first["corridor_type"], first["bni"], first["dki"]) == ("Mikrotrans", 2, 0)
    assert (second["corridor_type"], second["bni"], second["dki"]) == ("BRT Utama", 0, 3)


def test_approximate_riders_are_close(spark):
    riders = spark.range(1, 2001).select(
        F.col("id").alias("rider_key"),
        F.col("id").alias("rider_id"),
        *[F.lit("x").alias(c) for c in ("age_band", "rider_segment", "card_bank", "gender")],
    )
    fact = spark.range(1, 2001).select(
        F.col("id").alias("rider_key"),
        F.lit(1).alias("is_success"),
        F.lit(1).cast("decimal(10,2)").alias("paid"),
        F.lit(1).alias("duration_min"),
    )
    exact = olap.rider_profile(fact, riders).first()["riders"]
    close = olap.rider_profile(fact, riders, approximate=True).first()["riders"]
    assert exact == 2000 and abs(close - exact) < 200


# ------------------------------------------------------------------------------------ test views
def test_stops_of_any_key_have_a_place(spark, folder):
    keys = [(key, f"S{key}") for key in (0, 999, 1000, 59_999, 10**12)]
    spark.createDataFrame(keys, "s_suppkey bigint, s_name string").write.parquet(
        f"{folder}/supplier.parquet"
    )
    found = dimensions.table_stops(testviews.stop_table(spark, folder)).orderBy("stop_name")
    places = {r["stop_name"]: (r["latitude"], r["longitude"]) for r in found.collect()}
    assert places == {
        "S0": (Decimal("-6.0000000"), Decimal("106.0000000")),
        "S999": (Decimal("-6.0099900"), Decimal("106.0099900")),
        "S1000": (Decimal("-6.0100000"), Decimal("106.0100000")),
        "S59999": (Decimal("-6.5999900"), Decimal("106.5999900")),
        "S1000000000000": (None, None),
    }
    assert found.schema["latitude"].dataType.simpleString() == "decimal(10,7)"
