"""Expressions on hand-made values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions import casts, riders, routes, rules
from tapmart.functions import trips as t
from tapmart.functions.calendar import calendar_attributes
from tapmart.operators.cleaning import trim_all


def values(spark, rows, schema, *columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in frame.select(*columns).collect()]


def one(spark, rows, schema, column):
    return [r[0] for r in values(spark, rows, schema, column)]


def test_corridor_type(spark):
    ids = ["JAK.18", "R1A", "M7B", "13", "6C", "JIS3", "S21", None]
    expected = [
        "Jak Lingko",
        "Royaltrans",
        "Mikrotrans",
        "BRT Utama",
        "BRT Cabang",
        "Transjabodetabek",
        "Transjabodetabek",
        "Transjabodetabek",
    ]
    assert one(spark, [(i,) for i in ids], "c string", routes.corridor_type(F.col("c"))) == expected


def test_corridor_type_of_blank_ids(spark):
    rows = [(None,), ("",), ("UNKNOWN",), (" 5 ",)]
    found = one(spark, rows, "c string", routes.corridor_type_or_other(F.col("c")))
    assert found == ["Lainnya", "Lainnya", "Lainnya", "BRT Utama"]


def test_fleet_id(spark):
    day = date(2023, 4, 3)
    rows = [("5", 1, day), ("JAK.18", 0, day), (None, None, day), (None, None, None)]
    column = routes.fleet_id(F.col("c"), F.col("d"), F.col("t"))
    assert one(spark, rows, "c string, d int, t date", column) == [
        "ARM-5-1-20230403",
        "ARM-JAK.18-0-20230403",
        "ARM-UNK-0-20230403",
        "ARM-UNK-0-00000000",
    ]


def test_origin_and_destination_at_every_separator(spark):
    rows = [("A - B - C",), ("Loop",), (None,), ("X-Y - Z",)]
    name = F.col("n")
    found = values(spark, rows, "n string", routes.origin(name), routes.destination(name))
    assert found == [("A", "B"), ("Loop", None), (None, None), ("X-Y", "Z")]


def test_origin_and_destination_at_the_first_separator(spark):
    rows = [("A - B - C",), ("Loop",), (None,), ("",)]
    name = F.col("n")
    columns = (routes.origin_first_split(name), routes.destination_first_split(name))
    expected = [("A", "B - C"), ("Loop", ""), ("", ""), ("", "")]
    assert values(spark, rows, "n string", *columns) == expected


def test_day_part(spark):
    rows = [(h,) for h in (4, 5, 9, 10, 14, 15, 18, 19, None)]
    expected = ["Malam", "Pagi", "Pagi", "Siang", "Siang", "Sore", "Sore", "Malam", "Malam"]
    assert one(spark, rows, "h int", t.day_part(F.col("h"))) == expected


@pytest.mark.parametrize("data_type", ["timestamp", "timestamp_ntz"])
def test_durations(spark, data_type):
    def at(minute, second, micro=0):
        return datetime(2024, 5, 1, 7, minute, second, micro)

    rows = [
        (at(0, 0), at(30, 54)),
        (at(0, 0), at(30, 30)),
        (at(0, 0), at(31, 30)),
        (at(30, 30), at(0, 0)),
        (at(0, 0, 900_000), at(1, 0, 100_000)),
        (at(0, 0), None),
    ]
    a, b = F.col("a"), F.col("b")
    columns = (t.duration_truncated(a, b), t.duration_half_even(a, b))
    found = values(spark, rows, f"a {data_type}, b {data_type}", *columns)
    # Whole seconds count for the truncated form: 59.2 s from second 0 to second 60 is a minute.
    assert found == [(30, 31), (30, 30), (31, 32), (-30, -30), (1, 1), (None, None)]


def test_duration_too_long_for_its_type_is_null(spark):
    rows = [(datetime(2020, 1, 1), datetime(2024, 1, 1))]
    column = t.duration_truncated(F.col("a"), F.col("b"))
    assert one(spark, rows, "a timestamp_ntz, b timestamp_ntz", column) == [None]


def test_status(spark):
    out = datetime(2024, 5, 1)
    rows = [(None, 0), (out, 0), (out, 3500), (None, 3500)]
    column = t.status(F.col("o"), F.col("p"))
    assert one(spark, rows, "o timestamp_ntz, p int", column) == [
        presets.STATUS_INCOMPLETE,
        presets.STATUS_FREE,
        presets.STATUS_SUCCESS,
        presets.STATUS_INCOMPLETE,
    ]


def test_both_spellings_of_incomplete_are_one(spark):
    mixed = "Inkompl" + "ет"
    rows = [(mixed,), ("Inkomplet",), ("Sukses",), (None,)]
    found = one(spark, rows, "s string", t.normal_status(F.col("s")))
    assert found == [presets.STATUS_INCOMPLETE, presets.STATUS_INCOMPLETE, "Sukses", None]


@pytest.mark.parametrize(
    "table, expected",
    [
        (
            presets.AGE_BANDS_INCLUSIVE,
            ["<= 22 thn", "23-32 thn", "43-52 thn", ">= 53 thn", ">= 53 thn"],
        ),
        (
            presets.AGE_BANDS_NULL_AWARE,
            ["<= 22 thn", "23-32 thn", "43-52 thn", ">= 53 thn", "Tidak Diketahui"],
        ),
        (
            presets.AGE_BANDS_EXCLUSIVE,
            ["20-30 Tahun", "20-30 Tahun", "41-54 Tahun", "41-54 Tahun", ">= 55 Tahun"],
        ),
        (
            presets.SEGMENTS_NULL_AWARE,
            ["Mahasiswa", "Mahasiswa", "Pekerja", "Pekerja", "Tidak Diketahui"],
        ),
    ],
)
def test_bands(spark, table, expected):
    rows = [(a,) for a in (22, 23, 52, 53, None)]
    assert one(spark, rows, "a int", rules.bands(F.col("a"), table)) == expected


def test_birth_year_range(spark):
    rows = [("1939",), ("1940",), ("2015",), ("2016",), ("n/a",), ("1990.0",), ("1990.5",), (None,)]
    year = casts.try_number(F.col("y"), "int")
    found = one(spark, rows, "y string", casts.in_range(year, *presets.BIRTH_YEAR_RANGE))
    assert found == [None, 1940, 2015, None, None, 1990, 1990, None]


def test_whitelist(spark):
    bank = rules.whitelist(F.col("b"), presets.CARD_BANKS, presets.OTHER_BANK)
    assert one(spark, [(" DKI ",), ("visa",), (None,)], "b string", bank) == [
        "dki",
        "lainnya",
        "lainnya",
    ]


def test_numbers_of_19_digits_stay_exact(spark):
    rows = [("9007199254740993",), ("1e3",), ("nan",), ("inf",), ("99999999999999999999",)]
    found = one(spark, rows, "n string", casts.try_number(F.col("n"), "bigint"))
    assert found == [9007199254740993, 1000, None, None, None]
    found = one(spark, [("1.5",), ("nan",), ("x",)], "n string", casts.try_number(F.col("n")))
    assert found == [1.5, None, None]


def test_bad_times_are_null(spark):
    rows = [("2024-05-01 07:00:00",), ("2024-05-01 25:00",), ("soon",), (None,)]
    found = one(spark, rows, "s string", casts.try_timestamp(F.col("s")))
    assert found == [datetime(2024, 5, 1, 7), None, None, None]


def test_trim_all(spark):
    rows = spark.createDataFrame([(" a ", 1), (" nan ", 2), ("\tx\u00a0\n", 3), (None, 4)], "s string, n int")
    assert [r["s"] for r in trim_all(rows).collect()] == ["a", None, "x", None]


def test_calendar(spark):
    attributes = calendar_attributes(F.col("d"))
    wanted = ["day_of_week", "day_name", "is_weekend", "week_of_year", "month_name", "quarter"]
    rows = [(date(2023, 4, 2),), (date(2024, 12, 30),)]
    assert values(spark, rows, "d date", *[attributes[w] for w in wanted]) == [
        (7, "Sunday", 1, 13, "April", 2),
        (1, "Monday", 0, 1, "December", 4),
    ]


def test_region(spark):
    rows = [("Bogor",), ("Bandung",), (None,)]
    assert one(spark, rows, "c string", riders.region(F.col("c"))) == [
        "Jabodetabek",
        "Lainnya",
        "Lainnya",
    ]
    assert one(spark, rows[:1], "c string", riders.region(None)) == ["Tidak Diketahui"]
