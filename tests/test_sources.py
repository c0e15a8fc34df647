"""Flat files of differing headers and shapes, and JDBC options."""

import pytest
from fixtures import (
    COLUMNS,
    trip,
    write_csv,
    write_json_array,
    write_json_lines,
    write_xlsx,
)
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.sinks.jdbc import jdbc_write_options
from tapmart.sources import files
from tapmart.sources.tables import (
    JdbcTarget,
    Split,
    extract,
    jdbc_read_options,
    optional_table,
    read_parquet,
)


def ids(df):
    return [r[0] for r in df.orderBy(*files.ARRIVAL).select("transID").collect()]


def test_csv_columns_are_matched_by_name(spark, folder):
    write_csv(folder + "/a.csv", [trip(1), trip(2)])
    fewer = [*reversed(presets.REQUIRED_FILE_COLUMNS), "payCardBirthDate"]
    write_csv(folder + "/b.csv", [trip(3)], fewer)
    checks = files.check_files(spark, files.list_files(spark, folder))
    assert [c.problem for c in checks] == [None, None]
    rows = files.read_checked(spark, checks)
    assert ids(rows) == ["T1", "T2", "T3"]
    third = rows.where("transID = 'T3'").first()
    assert (third["payCardID"], third["tapInStopsName"]) == ("100", "One")
    assert (third["direction"], third["corridorID"], third["tapOutTime"]) == ("0", None, None)


def test_headers_with_blanks_and_cells_without_value(spark, folder):
    headers = [f" {name[:3]} {name[3:]} " for name in COLUMNS]
    rows = [trip(1, payCardBank="NA", corridorID=None), trip(2, payCardName='say "hi"')]
    path = write_csv(folder + "/a.csv", rows, headers=headers)
    first, second = files.read_file(spark, path).orderBy("row_number").collect()
    assert (first["payCardBank"], first["corridorID"]) == (None, None)
    assert first["payCardName"] == "A, Person" and second["payCardName"] == 'say "hi"'


def test_cells_with_line_breaks(spark, folder):
    path = write_csv(folder + "/a.csv", [trip(1, payCardName="two\nlines"), trip(2)])
    rows = files.read_file(spark, path, multi_line=True)
    assert ids(rows) == ["T1", "T2"]
    assert rows.where("transID = 'T1'").first()["payCardName"] == "two\nlines"


def test_a_header_alone_has_no_rows(spark, folder):
    assert files.read_file(spark, write_csv(folder + "/a.csv", [])).count() == 0


def test_rows_keep_the_order_of_the_file_over_many_blocks(spark, folder):
    write_csv(folder + "/a.csv", [trip(n) for n in range(3000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        rows = files.read_file(spark, folder + "/a.csv")
        assert rows.rdd.getNumPartitions() > 4
        assert ids(rows) == [f"T{n}" for n in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_arrays_and_json_lines(spark, folder):
    write_json_array(folder + "/a.json", [trip(1), trip(2, payCardName=None)])
    write_json_lines(folder + "/b.json", [trip(3), trip(4)])
    rows = files.read_checked(spark, files.check_files(spark, files.list_files(spark, folder)))
    assert ids(rows) == ["T1", "T2", "T3", "T4"]
    assert rows.where("payCardName IS NULL").count() == 1
    assert rows.first()["payAmount"] == "3500.0"


def test_workbooks(spark, folder):
    headers = [name.replace("pay", " pay ") for name in COLUMNS]
    write_xlsx(folder + "/a.xlsx", [trip(1), trip(2, tapOutTime=None)], headers=headers)
    write_xlsx(folder + "/b.xlsx", [trip(3)], list(reversed(COLUMNS)))
    rows = files.read_checked(spark, files.check_files(spark, files.list_files(spark, folder)))
    assert ids(rows) == ["T1", "T2", "T3"]
    second = rows.where("transID = 'T2'").first()
    assert (second["tapOutTime"], second["payAmount"], second["tapInStopsLat"]) == (
        None,
        "3500",
        "-6.2",
    )


def test_bad_files_are_told_apart(spark, folder):
    without_time = [c for c in COLUMNS if c != "tapInTime"]
    write_csv(folder + "/a.csv", [trip(1)], without_time)
    open(folder + "/b.csv", "w").close()
    rows = [{k: v for k, v in trip(2).items() if k != "payCardSex"}]
    write_json_lines(folder + "/c.json", rows)
    open(folder + "/d.txt", "w").close()
    with open(folder + "/e.xlsx", "w") as out:
        out.write("not a workbook")
    write_csv(folder + "/f.csv", [trip(3)])
    paths = [f"{folder}/{n}" for n in ("a.csv", "b.csv", "c.json", "d.txt", "e.xlsx", "f.csv")]
    problems = [c.problem for c in files.check_files(spark, paths)]
    assert "tapInTime" in problems[0]
    assert "empty" in problems[1]
    assert "payCardSex" in problems[2]
    assert "unsupported" in problems[3]
    assert "workbook" in problems[4]
    assert problems[5] is None
    with pytest.raises(ValueError, match="tapInTime"):
        files.read_file(spark, paths[0])
    with pytest.raises(ValueError, match="unsupported"):
        files.read_file(spark, paths[3])


def test_source_tag(spark):
    rows = spark.createDataFrame([("f/a.CSV",), ("f/b.json",), ("f/c.xlsx",), ("f/d",)], "f string")
    tags = [r[0] for r in rows.select(files.source_tag(F.col("f"))).collect()]
    assert tags == ["csv", "json", "excel", "file"]


def test_jdbc_options():
    target = JdbcTarget("jdbc:x:y", "a.Driver", {"user": "u", "password": "secret"})
    assert "secret" not in repr(target)
    plain = jdbc_read_options(target, table="trips")
    assert (plain["dbtable"], plain["fetchsize"], plain["user"]) == ("trips", "1000", "u")
    pushed = jdbc_read_options(target, query="SELECT 1")
    assert pushed["query"] == "SELECT 1" and "dbtable" not in pushed
    split = jdbc_read_options(target, query="SELECT 1", split=Split("id", 0, 9, 4))
    assert split["dbtable"].startswith("(SELECT 1)") and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_read_options(target)
    written = jdbc_write_options(target, "t", partitions=3)
    assert (written["batchsize"], written["numPartitions"]) == ("1000", "3")


def test_optional_tables(spark, folder):
    spark.range(3).write.parquet(folder + "/there")
    frames = extract(
        {
            "there": lambda: optional_table(spark, folder + "/there"),
            "absent": lambda: optional_table(spark, folder + "/absent"),
            "unnamed": lambda: optional_table(spark, "no_such_table"),
        }
    )
    assert list(frames) == ["there"]


def test_filters_and_columns_reach_the_scan(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    rows = read_parquet(
        spark, path, columns=["event_id"], where=F.col("event_type") == F.lit("view")
    )
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
