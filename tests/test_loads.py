"""Full and incremental loads into a stored star schema."""

import os

import pytest
from fixtures import COLUMNS, new_folder, trip, write_csv, write_json_lines
from pyspark.sql import functions as F

from tapmart import presets, testviews
from tapmart.operators import olap
from tapmart.plans.from_files import load_date_column, star_from_files
from tapmart.plans.incremental import load_files, load_folder
from tapmart.operators.trips import BAD_AMOUNT, BAD_CARD, BAD_TIME, MALFORMED, MISSING
from tapmart.sinks.audit import AUDIT_TABLE, REJECTED_TABLE
from tapmart.sinks.warehouse import FACT, Warehouse
from tapmart.streaming.folder import ingest_stream

SF_DIR = "/root/testdata/sf0.001"


def load_date():
    return load_date_column("2024-02-01")


@pytest.fixture
def warehouse(spark, folder):
    return Warehouse(spark, folder + "/warehouse")


def unresolved(star, fact_key, name):
    members = star[name].select(F.col(f"{name}_key").alias(fact_key))
    return star["fact"].join(members, fact_key, "left_anti").count()


def assert_sound(warehouse):
    """Every key resolves, keys and natural keys are unique, trips are loaded once."""
    star = warehouse.star()
    for fact_key, name in {
        "date_key": "date",
        "board_stop_key": "stop",
        "alight_stop_key": "stop",
        "route_key": "route",
        "rider_key": "rider",
        "fleet_key": "fleet",
        "feedback_category_key": "feedback_category",
    }.items():
        assert unresolved(star, fact_key, name) == 0, fact_key
        frame = star[name]
        assert frame.select(f"{name}_key").distinct().count() == frame.count()
    assert star["fact"].select("trip_id").distinct().count() == star["fact"].count()


def test_full_load_and_reports_on_the_stored_star(spark, warehouse):
    rows = testviews.taps(spark, SF_DIR)
    built = star_from_files(rows, testviews.ARRIVAL, load_date(), "csv", "b1")
    fact = built.pop("fact")
    built["feedback_category"] = spark.range(0).select(
        F.lit(1).alias("feedback_category_key"),
        F.lit("x").alias("category_name"),
        F.lit("x").alias("description"),
    )
    for _ in range(2):
        warehouse.load_all(built, fact)
    assert_sound(warehouse)
    star = warehouse.star()
    needed = ["transID", "payCardID", "tapInTime", "tapInStops"]
    whole = rows.dropna(subset=needed).select("transID").distinct()
    assert star["fact"].count() == whole.count()
    # The view leaves out the time of every 211th event.
    lost = rows.join(whole, "transID", "left_anti")
    assert lost.select("transID").distinct().count() == 5
    assert lost.where("tapInTime IS NOT NULL").count() == 0
    assert star["date"].where("date_key = -1").count() == 1
    trend = olap.daily_trend(star["fact"], star["date"])
    assert trend.agg(F.sum("trips")).first()[0] == star["fact"].where("is_success = 1").count()
    one_day = star["fact"].where("travel_date = DATE '2024-01-05'")
    assert "PartitionFilters: [isnotnull(travel_date" in (
        one_day._jdf.queryExecution().executedPlan().toString()
    )


def test_incremental_load_adds_what_is_new_and_nothing_twice(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1), trip(2), trip(2, payAmount=0)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.added[FACT] == 2 and not result.rejected
    assert_sound(warehouse)
    before = {n: f.count() for n, f in warehouse.star().items()}

    again = load_folder(spark, drop, warehouse, "b1-again", load_date())
    assert set(again.added.values()) == {0}
    assert {n: f.count() for n, f in warehouse.star().items()} == before

    # The same trip in two files of a batch and in an earlier one, a new rider, a known stop
    # under another name, a known trip on another day.
    write_csv(drop + "/b.csv", [trip(3, payAmount=1), trip(2, tapInTime="2023-04-20 07:00:00")])
    write_json_lines(
        drop + "/c.json",
        [
            trip(3, payAmount=2),
            trip(4, payCardID=999, payCardName="New", tapInStopsName="Another"),
            trip(5, tapOutStops=None, tapOutTime=None, corridorID=None),
        ],
    )
    paths = [drop + "/c.json", drop + "/b.csv"]
    result = load_files(warehouse, paths, "b2", load_date())
    assert result.added[FACT] == 3
    assert result.added["dim_rider"] == 2
    assert result.added["dim_stop"] == 0
    assert_sound(warehouse)
    star = warehouse.star()
    facts = {r["trip_id"]: r for r in star["fact"].collect()}
    assert len(facts) == 5
    assert facts["T3"]["paid"] == 1  # from the first file by name
    assert (facts["T3"]["source"], facts["T4"]["source"]) == ("csv", "json")
    assert facts["T5"]["status"] == presets.STATUS_INCOMPLETE
    assert (facts["T5"]["alight_stop_key"], facts["T5"]["route_key"]) == (-1, -1)
    assert facts["T1"]["duration_min"] == 30  # 30.5 minutes, to the even one
    riders = {r["rider_id"]: r["rider_key"] for r in star["rider"].collect()}
    assert sorted(riders.values()) == [-1, 1, 2, 3, 4]
    assert riders[999] == 4
    names = {r["stop_id"]: r["stop_name"] for r in star["stop"].collect()}
    assert names["P1"] == "One"


def test_the_first_file_with_a_usable_row_has_the_trip(spark, folder, warehouse):
    """A bad tap-in time spoils a trip in its own file only."""
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1, tapInTime="never"), trip(1)])
    write_csv(drop + "/b.csv", [trip(1, payAmount=7)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.added[FACT] == 1
    assert warehouse.read(FACT).first()["paid"] == 7


def test_bad_files_do_not_stop_good_ones_and_are_logged(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1)], [c for c in COLUMNS if c != "transID"])
    write_csv(drop + "/b.csv", [trip(2)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert len(result.rejected) == 1 and result.added[FACT] == 1
    log = warehouse.read(AUDIT_TABLE)
    (failed,) = log.where(F.col("status") == presets.AUDIT_FAILED).collect()
    assert "transID" in failed["error"] and failed["source"].endswith("a.csv")
    (loaded,) = log.where(F.col("target") == FACT).where("row_count = 1").collect()
    assert loaded["status"] == presets.AUDIT_PARTIAL
    assert loaded["finished_at"] >= loaded["started_at"]


def test_only_bad_files(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    open(drop + "/a.csv", "w").close()
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.added == {} and len(result.rejected) == 1
    assert load_folder(spark, new_folder(folder, "none"), warehouse, "b2", load_date()).added == {}


def test_stream_of_files(spark, folder, warehouse):
    drop, checkpoint = new_folder(folder, "drop"), folder + "/checkpoint"
    results = []

    def run(where=checkpoint):
        ingest_stream(
            spark, drop, warehouse, where, load_date, on_batch=results.append
        ).awaitTermination()

    write_csv(drop + "/a.csv", [trip(n) for n in range(5)])
    run()
    assert results[-1].added[FACT] == 5
    run()
    assert len(results) == 1  # nothing arrived, so there was no batch
    write_csv(drop + "/b.csv", [trip(n) for n in range(3, 8)])
    open(drop + "/notes.txt", "w").close()
    run()
    assert results[-1].added[FACT] == 3
    assert_sound(warehouse)
    # A lost checkpoint brings all files again, and adds nothing.
    run(folder + "/new-checkpoint")
    assert set(results[-1].added.values()) == {0}
    assert warehouse.read(FACT).count() == 8


def test_what_a_broken_write_left_behind_is_no_table(spark, folder, warehouse):
    os.makedirs(warehouse.path("dim_stop") + "/_temporary/0/task")
    spark.range(1).write.parquet(warehouse.path("dim_stop") + "/_temporary/0/task/out")
    assert not warehouse.exists("dim_stop")
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1)])
    assert load_folder(spark, drop, warehouse, "b1", load_date()).added["dim_stop"] == 2
    assert_sound(warehouse)


def test_stored_tables_stay_small_in_number_of_files(spark, warehouse):
    rows = testviews.taps(spark, SF_DIR)
    star = star_from_files(rows, testviews.ARRIVAL, load_date(), "csv", "b1", names=["date"])
    warehouse.write_fact(star["fact"])
    for entry in os.scandir(warehouse.path(FACT)):
        if entry.is_dir():
            assert len([f for f in os.listdir(entry.path) if f.endswith(".parquet")]) == 1


def assert_counted(result):
    rows = dict(result.rows)
    assert rows.pop("read") == sum(rows.values())


def test_a_broken_json_line_is_rejected_and_counted(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    path = write_json_lines(drop + "/a.json", [trip(1), trip(2), trip(3)])
    lines = open(path, encoding="utf-8").read().splitlines()
    lines[1] = lines[1][:40]
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.rows["read"] == 3 and result.rows["added"] == 2 and result.rows[MALFORMED] == 1
    assert_counted(result)
    (rejected,) = warehouse.read(REJECTED_TABLE).collect()
    assert rejected["record"] == lines[1] and rejected["reason"] == MALFORMED
    statuses = warehouse.read(AUDIT_TABLE).select("status").distinct().collect()
    assert [r["status"] for r in statuses] == [presets.AUDIT_PARTIAL]


def test_a_csv_row_with_a_field_too_many_is_rejected(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    path = write_csv(drop + "/a.csv", [trip(1)])
    with open(path, "a", encoding="utf-8") as out:
        out.write("extra," + open(path, encoding="utf-8").read().splitlines()[1] + "\n")
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert (result.rows["added"], result.rows[MALFORMED]) == (1, 1)
    assert_counted(result)


def test_a_cell_with_a_line_break_is_read_by_default(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1, payCardName="A\nPerson"), trip(2)])
    write_csv(drop + "/b.csv", [trip(3)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.rows["read"] == result.rows["added"] == 3


def test_bad_values_stop_neither_their_file_nor_others(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1), trip(2, tapInTime="17/04/2023 07:00")])
    bad = [
        trip(3, payAmount=123456789012),
        trip(4, payCardID="CARD-77"),
        trip(5, tapInTime="some day"),
        trip(6, transID=""),
        trip(7),
        trip(7, payAmount=1),
    ]
    write_csv(drop + "/b.csv", bad)
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.rows == {
        "read": 8, "added": 3, "duplicate": 1, "skipped": 0, "look_up_missed": 0, MALFORMED: 0,
        MISSING: 1, BAD_TIME: 1, BAD_CARD: 1, BAD_AMOUNT: 1,
    }
    times = {r["trip_id"]: str(r["tap_in_at"]) for r in warehouse.read(FACT).collect()}
    assert times["T2"] == "2023-04-17 07:00:00"
    reasons = {r["trip_id"]: r["reason"] for r in warehouse.read(REJECTED_TABLE).collect()}
    assert reasons == {"T3": BAD_AMOUNT, "T4": BAD_CARD, "T5": BAD_TIME, None: MISSING}
    again = load_folder(spark, drop, warehouse, "b2", load_date())
    assert again.rows["skipped"] == 3 and again.rows["added"] == 0
    assert_counted(again)


def test_names_that_decode_to_the_same_text_are_two_files(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/x y.csv", [trip(1)])
    write_csv(drop + "/x%20y.csv", [trip(2)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert result.rows["added"] == 2 and not result.rejected


def test_many_bad_files_are_logged_in_one_go(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    for n in range(60):
        write_csv(f"{drop}/bad{n:03}.csv", [trip(n)], [c for c in COLUMNS if c != "transID"])
    write_csv(drop + "/good.csv", [trip(1)])
    result = load_folder(spark, drop, warehouse, "b1", load_date())
    assert len(result.rejected) == 60 and result.rows["added"] == 1
    failed = warehouse.read(AUDIT_TABLE).where(F.col("status") == presets.AUDIT_FAILED)
    assert failed.count() == 60
