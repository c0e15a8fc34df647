"""Batches of a stream that are stopped half-way and given again."""

import pytest
from fixtures import new_folder, trip, write_csv
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.plans import incremental
from tapmart.plans.from_files import load_date_column
from tapmart.sinks.audit import AUDIT_TABLE
from tapmart.sinks.ledger import LEDGER, Ledger
from tapmart.sinks.warehouse import FACT, Warehouse
from tapmart.streaming.folder import ingest_stream


def run(spark, drop, warehouse, checkpoint, results, **more):
    ingest_stream(
        spark, drop, warehouse, checkpoint, lambda: load_date_column("2024-02-01"),
        on_batch=results.append, **more,
    ).awaitTermination()


def lines_of(warehouse, batch_id):
    rows = warehouse.read(AUDIT_TABLE).where(F.col("batch_id") == batch_id)
    done = rows.where(F.col("status") != presets.AUDIT_FAILED).collect()
    assert len({r["target"] for r in done}) == len(done)
    return {r["target"]: r["row_count"] for r in done}


@pytest.mark.parametrize("where", ["resync_fact", "audit_rows", "commit"])
def test_a_batch_stopped_half_way_is_finished_and_logged_once(spark, folder, monkeypatch, where):
    """Stopped between dimensions and fact, between fact and log, and before the commit."""
    warehouse = Warehouse(spark, folder + "/warehouse")
    drop, checkpoint, results = new_folder(folder, "drop"), folder + "/checkpoint", []
    write_csv(drop + "/a.csv", [trip(1), trip(2)])
    run(spark, drop, warehouse, checkpoint, results)
    write_csv(drop + "/b.csv", [trip(2), trip(3, payCardID=77), trip(4, tapInStops="P9")])
    owner = Ledger if where == "commit" else incremental

    def stop(*a, **k):
        raise RuntimeError("stopped here")

    with monkeypatch.context() as patch:
        patch.setattr(owner, where, stop)
        with pytest.raises(Exception, match="stopped here"):
            run(spark, drop, warehouse, checkpoint, results)
    assert len(results) == 1
    run(spark, drop, warehouse, checkpoint, results)
    result = results[-1]
    assert result.added["dim_rider"] == 1 and result.added["dim_stop"] == 1
    assert result.rows["added"] == 2 and result.rows["skipped"] == 1
    assert result.rows["read"] == sum(v for k, v in result.rows.items() if k != "read")
    assert warehouse.read(FACT).count() == 4
    told = lines_of(warehouse, result.batch_id)
    assert (told[FACT], told["dim_rider"], told["dim_stop"]) == (2, 1, 1)
    states = spark.read.json(f"{warehouse.root}/{LEDGER}").groupBy("state").count().collect()
    assert {r["state"]: r["count"] for r in states} == {"intent": 2, "commit": 2}


def test_a_committed_batch_is_skipped_and_streams_are_told_apart(spark, folder, monkeypatch):
    warehouse = Warehouse(spark, folder + "/warehouse")
    drop, results = new_folder(folder, "drop"), []
    write_csv(drop + "/a.csv", [trip(1, tapInTime="17.04.2023 07|00")])
    formats = ["dd.MM.yyyy HH|mm"]
    run(spark, drop, warehouse, folder + "/one", results, time_formats=formats)
    assert results[0].rows["added"] == 1
    assert str(warehouse.read(FACT).first()["tap_in_at"]) == "2023-04-17 07:00:00"
    run(spark, drop, warehouse, folder + "/two", results, time_formats=formats)
    assert results[1].batch_id != results[0].batch_id and results[1].rows["added"] == 0
    # A batch that Spark gives again after its commit.
    (stream,) = {r["stream"] for r in spark.read.json(f"{warehouse.root}/{LEDGER}").collect()
                 if r["stream"][:12] in results[0].batch_id}
    assert Ledger(warehouse, stream).begin(0).done
