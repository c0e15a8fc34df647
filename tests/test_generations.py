"""Full loads that go live at once, and the index of stored trips."""

import pytest
from fixtures import new_folder, trip, write_csv
from pyspark.sql import functions as F

from tapmart.operators.loading import skip_existing
from tapmart.plans.from_files import load_date_column
from tapmart.plans.incremental import load_folder
from tapmart.sinks import trip_index
from tapmart.sinks.trip_index import TripIndex
from tapmart.sinks.warehouse import FACT, Warehouse


@pytest.fixture
def warehouse(spark, folder):
    return Warehouse(spark, folder + "/warehouse")


class Stop(Exception):
    pass


def star_of(spark, label):
    """Two stops and two trips that belong together, told apart by ``label``."""
    stops = spark.createDataFrame(
        [(1, "P1", label), (2, "P2", label)], "stop_key bigint, stop_id string, stop_name string"
    )
    fact = spark.createDataFrame(
        [(f"{label}-{n}", n, "b", "2024-01-05 07:00:00") for n in (1, 2)],
        "trip_id string, board_stop_key bigint, batch_id string, at string",
    )
    return {"stop": stops}, fact.withColumn("tap_in_at", F.col("at").cast("timestamp_ntz")).drop("at")


def seen(star):
    joined = star["fact"].join(
        star["stop"], star["fact"]["board_stop_key"] == star["stop"]["stop_key"], "left"
    )
    return {(r["trip_id"].split("-")[0], r["stop_name"]) for r in joined.collect()}


def test_a_load_stopped_at_any_step_leaves_the_old_star(spark, warehouse, monkeypatch):
    warehouse.load_all(*star_of(spark, "old"))
    assert seen(warehouse.star()) == {("old", "old")}
    steps = [
        (Warehouse, "replace"), (Warehouse, "write_fact"), (TripIndex, "rebuild"),
        (Warehouse, "go_live"), (Warehouse, "_publish"),
    ]
    for owner, name in steps:
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, lambda *a, **k: (_ for _ in ()).throw(Stop(name)))
            with pytest.raises(Stop):
                warehouse.load_all(*star_of(spark, "new"))
        assert seen(warehouse.star()) == {("old", "old")}, name
        assert warehouse.trip_index().is_sound()
    # Stopped after the rename: the new star is live as a whole.
    monkeypatch.setattr(Warehouse, "_tidy", lambda *a: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        warehouse.load_all(*star_of(spark, "new"))
    assert seen(warehouse.star()) == {("new", "new")}


def test_a_reader_keeps_the_generation_it_began_with(spark, warehouse):
    warehouse.load_all(*star_of(spark, "old"))
    reader = warehouse.snapshot()
    before = reader.star()
    warehouse.load_all(*star_of(spark, "new"))
    assert seen(before) == seen(reader.star()) == {("old", "old")}
    assert seen(warehouse.star()) == {("new", "new")}


def test_generations_before_the_last_two_are_removed(spark, folder, warehouse):
    import os

    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1), trip(2)])
    load_folder(spark, drop, warehouse, "b1", load_date_column("2024-02-01"))
    assert os.path.isdir(warehouse.root + "/" + FACT)
    riders = warehouse.dimension("rider").count()
    for label in ("one", "two", "three"):
        warehouse.load_all(*star_of(spark, label))
    kept = sorted(n for n in os.listdir(warehouse.root) if n.startswith("gen-"))
    assert len(kept) == 2 and not os.path.exists(warehouse.root + "/" + FACT)
    # A dimension that no full load brought stays where it is.
    assert warehouse.dimension("rider").count() == riders
    assert os.path.isdir(warehouse.root + "/dim_rider")


def test_a_load_after_a_full_load_adds_to_the_live_generation(spark, folder, warehouse):
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(n) for n in range(6)])
    load_folder(spark, drop, warehouse, "b1", load_date_column("2024-02-01"))
    star = warehouse.star()
    fact = star.pop("fact").drop("travel_date")
    warehouse.load_all(star, fact)
    write_csv(drop + "/b.csv", [trip(n) for n in range(4, 9)])
    result = load_folder(spark, drop, warehouse, "b2", load_date_column("2024-02-01"))
    assert result.rows["added"] == 3 and result.rows["skipped"] == 8
    ids = [r["trip_id"] for r in warehouse.read(FACT).collect()]
    assert sorted(ids) == [f"T{n}" for n in range(9)]
    assert "gen-" in warehouse.path(FACT) and warehouse.trip_index().is_sound()


# ------------------------------------------------------------------------------------- the index
def stored_trips(spark, warehouse, count):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int"))
    rows = spark.range(count).select(
        F.concat(F.lit("T"), "id").alias("trip_id"), day.cast("timestamp_ntz").alias("tap_in_at")
    )
    warehouse.write_fact(rows)
    index = warehouse.trip_index()
    index.rebuild()
    return index


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_new_ids_read_few_buckets_and_never_the_fact(spark, warehouse, monkeypatch):
    monkeypatch.setattr(trip_index, "MIN_BUCKETS", 64)
    index = stored_trips(spark, warehouse, 20_000)
    fresh = spark.range(100).select(F.concat(F.lit("N"), "id").alias("trip_id"))
    possible = index.possibly_stored(fresh, 100)
    assert possible.count() <= 10  # five hashes on ten bits let one in a hundred through
    batch = fresh.union(spark.createDataFrame([("T7",), ("T7",), ("T19999",)], "trip_id string"))
    stored = index.stored_ids(batch, 103)
    assert sorted(r[0] for r in stored.collect()) == ["T19999", "T7"]
    plan = plan_of(skip_existing(batch, stored))
    assert "fact_trip" not in plan
    read = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "bucket" in read and read.count(",") < 20
    assert skip_existing(batch, stored).count() == 100


def test_filters_hold_every_id_with_parts_and_slices(spark, warehouse, monkeypatch):
    monkeypatch.setattr(trip_index, "BUCKET_IDS", 100)
    monkeypatch.setattr(trip_index, "SLICE_IDS", 7)
    index = stored_trips(spark, warehouse, 3_000)
    assert index._buckets() == 32
    extra = spark.range(9_000).select(F.concat(F.lit("E"), "id").alias("trip_id"))
    index.open()
    assert not index.is_sound()
    index.add(extra, 9_000)
    assert index.is_sound()
    assert warehouse.read(TripIndex.FILTERS).agg(F.max("parts")).first()[0] == 3
    everything = extra.union(warehouse.read(FACT).select("trip_id"))
    assert index.stored_ids(everything, 12_000).count() == 12_000
    others = spark.range(5_000).select(F.concat(F.lit("X"), "id").alias("trip_id"))
    assert index.possibly_stored(others, 5_000).count() < 300
    assert index.stored_ids(others, 5_000).count() == 0
    assert index.stored_ids(others.where("trip_id = ''"), 0).count() == 0


@pytest.mark.parametrize("step", ["_write", "close"])
def test_a_load_stopped_between_fact_and_index_is_made_good(spark, folder, warehouse, monkeypatch, step):
    load_date = load_date_column("2024-02-01")
    drop = new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1), trip(2)])
    load_folder(spark, drop, warehouse, "b1", load_date)
    write_csv(drop + "/b.csv", [trip(3), trip(4)])
    with monkeypatch.context() as patch:
        patch.setattr(TripIndex, step, lambda *a: (_ for _ in ()).throw(Stop(step)))
        with pytest.raises(Stop):
            load_folder(spark, drop, warehouse, "b2", load_date)
    assert warehouse.read(FACT).count() == 4 and not warehouse.trip_index().is_sound()
    again = load_folder(spark, drop, warehouse, "b3", load_date)
    assert again.rows["added"] == 0 and again.rows["skipped"] == 4
    assert warehouse.read(FACT).count() == 4 and warehouse.trip_index().is_sound()
