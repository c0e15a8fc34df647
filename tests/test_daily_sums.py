"""Sums and sketches that loads keep, against the reports on the fact."""

import zipfile

import pytest
from fixtures import new_folder, trip, write_csv, write_xlsx
from pyspark.sql import functions as F

from tapmart.operators import olap
from tapmart.operators.trips import MALFORMED
from tapmart.plans.from_files import load_date_column
from tapmart.plans.incremental import load_folder
from tapmart.sinks.audit import REJECTED_TABLE
from tapmart.sinks.daily_sums import DailySums
from tapmart.sinks.warehouse import FACT, Warehouse


def rows(report):
    return [tuple(r) for r in report.collect()]


def assert_same_reports(warehouse):
    star, sums = warehouse.star(), warehouse.daily_sums()
    for report, name in (
        (olap.daily_trend, "date"),
        (olap.daily_rollup, "date"),
        (olap.corridor_bank, "route"),
        (olap.hour_direction, "date"),
    ):
        assert rows(report(sums.trips(), star[name])) == rows(report(star["fact"], star[name]))
    exact = olap.rider_profile(star["fact"], star["rider"])
    # A few riders are counted exactly by a sketch.
    assert rows(olap.rider_profile_from_sums(sums.riders())) == rows(exact)
    plan = olap.daily_trend(sums.trips(), star["date"])._jdf.queryExecution().toString()
    assert FACT not in plan


def test_sums_follow_loads_out_of_order_and_a_stop(spark, folder, monkeypatch):
    warehouse = Warehouse(spark, folder + "/warehouse")
    times = [f"2023-04-{day:02} 07:15:00" for day in (20, 3, 11, 3)]
    for n, time in enumerate(times):
        drop = new_folder(folder, f"drop{n}")
        taps = [trip(10 * n + i, tapInTime=time) for i in range(3)]
        write_csv(drop + "/a.csv", [*taps, trip(0, tapInTime=times[0])])
        if n < 3:
            load_folder(spark, drop, warehouse, f"b{n}", load_date_column("2024-02-01"))
            assert_same_reports(warehouse) if n else None
            continue
        # Stopped after the fact was written and before its sums: the next load mends them.
        with monkeypatch.context() as stop, pytest.raises(KeyboardInterrupt):
            stop.setattr(DailySums, "add", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
            load_folder(spark, drop, warehouse, "b3", load_date_column("2024-02-01"))
        assert warehouse.daily_sums().trips().agg(F.sum("trips")).first()[0] < warehouse.read(FACT).count()
        load_folder(spark, drop, warehouse, "b4", load_date_column("2024-02-01"))
    assert_same_reports(warehouse)


def test_a_damaged_workbook_stops_no_other_file(spark, folder):
    warehouse, drop = Warehouse(spark, folder + "/warehouse"), new_folder(folder, "drop")
    write_csv(drop + "/a.csv", [trip(1)])
    write_xlsx(drop + "/b.xlsx", [trip(2), trip(3, payAmount="@@"), trip(4)])
    write_xlsx(drop + "/c.xlsx", [trip(5), trip(6)])
    for name, change in (
        ("b", lambda s: s.replace('<c t="inlineStr"><is><t>@@</t></is></c>', "<c><v>abc</v></c>")),
        ("c", lambda s: s[: s.rindex("<row>") + 40]),
    ):
        with zipfile.ZipFile(f"{drop}/{name}.xlsx") as book:
            parts = {n: book.read(n).decode() for n in book.namelist()}
        sheet = "xl/worksheets/sheet1.xml"
        assert parts[sheet] != change(parts[sheet])
        parts[sheet] = change(parts[sheet])
        with zipfile.ZipFile(f"{drop}/{name}.xlsx", "w") as book:
            for part, text in parts.items():
                book.writestr(part, text)
    result = load_folder(spark, drop, warehouse, "b1", load_date_column("2024-02-01"))
    stored = {r["trip_id"] for r in warehouse.read(FACT).collect()}
    assert stored == {"T1", "T2", "T4", "T5"} and result.rows[MALFORMED] == 2
    records = sorted(r["record"] for r in warehouse.read(REJECTED_TABLE).collect())
    assert "abc" in records[0] and "T3" in records[0] and "cannot be read" in records[1]
