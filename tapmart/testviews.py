"""Trip-shaped views of the given test tables, in Spark and, for the oracle, in DuckDB SQL.

``taps`` looks like rows of a flat trip file, with dirty values; the others look like relational
source tables. Every event gives one row. One event in twenty is delivered a second time, which
adds rows and removes none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapmart import presets

ARRIVAL = ("ingest_seq",)

# Shared column texts, in Spark SQL. DuckDB calls STRING and array() otherwise, see _duckdb.
def _pick(index: str, *values: str | None) -> str:
    """One of the values by a number that counts from 0."""
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"element_at(array({texts}), CAST({index} AS INT) + 1)"


_STOP_IN = "CAST((event_id % 997) * (event_id % 997) % 997 % 41 AS STRING)"
_STOP_OUT = "CAST((event_id * 7) % 53 AS STRING)"
_SECONDS = "CAST(600 + (event_id * 37) % 5400 AS INT)"
_OUT = "CASE WHEN event_type <> 'error' THEN {} END"
# A rider may have two card issuers, two birth years, and rows without one.
_BANKS = _pick(
    "(user_id + event_id % 2) % 8", "DKI", " emoney ", "brizzi", "flazz", "online", "bni", "visa", None
)
_ROUTE_IDS = _pick(
    "event_id % 9", "5", "12", "6C", "R1A", "M7B", "JAK.18", "JIS3", "S21", None
)
_ROUTE_NAMES = _pick(
    "event_id % 9",
    "North - Coast",
    "Harbour - Port",
    "Hill - Park - City",
    "Lake - Square",
    "Loop",
    "X-Y - Z",
    " Padded - Name ",
    "S - T via U",
    None,
)
_TAPS = {
    "transID": "'TRX' || CAST(event_id AS STRING)",
    "payCardID": "user_id",
    "payCardBank": _BANKS,
    "payCardName": "'Card ' || CAST(user_id AS STRING)",
    "payCardSex": _pick("user_id % 4", "m", "F", "X", None),
    "payCardBirthDate": """CASE WHEN user_id % 17 = 0 THEN 'n/a' WHEN event_id % 5 = 0 THEN NULL
        ELSE CAST(1932 + user_id % 89 + event_id % 3 AS STRING) END""",
    "corridorID": _ROUTE_IDS,
    "corridorName": _ROUTE_NAMES,
    "direction": "CASE WHEN event_id % 13 <> 0 THEN event_id % 2 END",
    "tapInStops": f"'P' || lpad({_STOP_IN}, 5, '0')",
    "tapInStopsName": f"'Stop ' || {_STOP_IN}",
    "tapInStopsLat": f"'-6.' || lpad({_STOP_IN}, 3, '0')",
    "tapInStopsLon": f"'106.' || lpad({_STOP_IN}, 3, '0')",
    "stopStartSeq": "CAST(event_id % 30 AS STRING)",
    "tapOutStops": _OUT.format(f"'P' || lpad({_STOP_OUT}, 5, '0')"),
    "tapOutStopsName": _OUT.format(f"'Out ' || {_STOP_OUT}"),
    "tapOutStopsLat": _OUT.format(f"'-7.' || lpad({_STOP_OUT}, 3, '0')"),
    "tapOutStopsLon": _OUT.format(f"'107.' || lpad({_STOP_OUT}, 3, '0')"),
    "stopEndSeq": _OUT.format("CAST(event_id % 30 + 4 AS STRING)"),
    "tapInTime": "CASE WHEN event_id % 211 <> 0 THEN ts END",
    "tapOutTime": _OUT.format(f"ts + INTERVAL '1' SECOND * {_SECONDS}"),
    "payAmount": "CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 20000 ELSE 3500 END",
    "event_id": "event_id",
    "created_at": "ts",
}
# Repeated rows arrive after all first deliveries.
_SECOND_DELIVERY = "event_id % 20 = 0"
_SECOND_OFFSET = 1_000_000_000_000

# Trip table: other names and types, and the status as a source would store it.
_TRIPS = {
    "trip_id": _TAPS["transID"],
    "rider_id": "CASE WHEN event_id % 31 = 0 THEN 90000000 + user_id ELSE user_id + 100 END",
    "route_id": _TAPS["corridorID"],
    "board_stop_id": f"CASE WHEN event_id % 29 = 0 THEN 'P99999' ELSE {_TAPS['tapInStops']} END",
    "alight_stop_id": _TAPS["tapOutStops"],
    "direction": f"CAST({_TAPS['direction']} AS SMALLINT)",
    "board_seq": "CAST(event_id % 30 AS SMALLINT)",
    "alight_seq": _OUT.format("CAST(event_id % 30 + 4 AS SMALLINT)"),
    "tap_in_at": "ts",
    "tap_out_at": _TAPS["tapOutTime"],
    "paid": f"CAST({_TAPS['payAmount']} AS DECIMAL(10,2))",
    "status": """CASE event_type WHEN 'signup' THEN 'Gratis' WHEN 'error' THEN 'Inkomplет'
        WHEN 'click' THEN 'Inkomplet' ELSE 'Sukses' END""",
    "created_at": "ts",
    "event_id": "event_id",
}
_RIDERS = {
    "rider_id": "c_custkey",
    "rider_name": "c_name",
    "card_bank": _pick(
        "c_custkey % 8", "dki", "emoney", "brizzi", "flazz", "online", "bni", "lainnya", "lainnya"
    ),
    "gender": _pick("c_custkey % 3", "M", "F", "Tidak Disebutkan"),
    "birth_year": "CAST(CASE WHEN c_custkey % 17 <> 0 THEN 1940 + c_custkey % 76 END AS SMALLINT)",
    "home_city": _pick(
        "c_nationkey % 5", "Bogor", "Jakarta Timur", "Bekasi", "Bandung", None
    ),
}
_STOPS = {
    "stop_id": "'P' || lpad(CAST(s_suppkey AS STRING), 5, '0')",
    "stop_name": "' ' || s_name || ' '",
    "latitude": "CAST(-6 - CAST(s_suppkey AS DECIMAL(10,7)) / 100000 AS DECIMAL(10,7))",
    "longitude": "CAST(106 + CAST(s_suppkey AS DECIMAL(10,7)) / 100000 AS DECIMAL(10,7))",
}
# As DECIMAL(10,7) a key may be 999 at most, so Spark takes it whole. A place off the map's type is
# null.
_STOPS_BY_ANY_KEY = _STOPS | {
    "latitude": "TRY_CAST(-6 - CAST(s_suppkey AS DECIMAL(19,0)) / 100000 AS DECIMAL(10,7))",
    "longitude": "TRY_CAST(106 + CAST(s_suppkey AS DECIMAL(19,0)) / 100000 AS DECIMAL(10,7))",
}
_CATEGORIES = [name for _, name, _ in presets.FEEDBACK_CATEGORIES]
# Orders stand for feedback; they cover every other trip, and trips that do not exist.
_FEEDBACK = {
    "trip_id": "'TRX' || CAST(o_orderkey * 2 AS STRING)",
    "rating": "CAST(1 + o_orderkey % 5 AS SMALLINT)",
    "comment": "o_orderpriority",
    "category": _pick("o_orderkey % 4", *_CATEGORIES, "Saran"),
    "created_at": "o_orderdate",
    "event_id": "o_orderkey",
}
# What a second delivery says otherwise than the first.
_TAPS_AGAIN = {"payAmount": "payAmount + 500"}
_TRIPS_AGAIN = {"paid": "CAST(paid + 500 AS DECIMAL(10,2))"}
_FEEDBACK_AGAIN = {"rating": "CAST(6 - rating AS SMALLINT)"}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _deliveries(rows: DataFrame, columns: dict[str, str], again: dict[str, str]) -> DataFrame:
    """First and second deliveries out of one scan."""
    copies = f"explode(CASE WHEN {_SECOND_DELIVERY} THEN array(0, 1) ELSE array(0) END) AS _copy"
    later = F.col("created_at") + F.col("_copy") * F.expr("INTERVAL '1' HOUR")
    changed = {
        name: F.expr(f"CASE WHEN _copy = 1 THEN {text} ELSE {name} END")
        for name, text in again.items()
    }
    return (
        rows.selectExpr(*_select(columns))
        .selectExpr("*", copies)
        .withColumns({"created_at": later, **changed})
        .withColumn("ingest_seq", F.col("_copy") * F.lit(_SECOND_OFFSET) + F.col("event_id"))
        .drop("_copy")
    )


def taps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deliveries(table(spark, sf_dir, "events"), _TAPS, _TAPS_AGAIN)


def trip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deliveries(table(spark, sf_dir, "events"), _TRIPS, _TRIPS_AGAIN).drop("event_id")


def rider_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_select(_RIDERS))


def stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*_select(_STOPS_BY_ANY_KEY))


def route_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"route_id": _TAPS["corridorID"], "route_name": _TAPS["corridorName"]}
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*_select(columns)).dropna(subset=["route_id"]).distinct()


def feedback_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback on part of the trips; some of it was given twice."""
    return _deliveries(table(spark, sf_dir, "orders"), _FEEDBACK, _FEEDBACK_AGAIN).drop("event_id")


# --------------------------------------------------------------------------- the same in DuckDB
def _duckdb(text: str) -> str:
    text = text.replace("AS STRING", "AS VARCHAR")
    return text.replace("element_at(array(", "list_extract(list_value(")


def _duckdb_deliveries(columns: dict[str, str], again: dict[str, str], source: str) -> str:
    base = _duckdb(",\n".join(_select(columns)))
    changed = ", ".join(f"{text} AS {name}" for name, text in again.items())
    return f"""
    SELECT *, event_id AS ingest_seq FROM (SELECT {base} FROM {source})
    UNION ALL
    SELECT * REPLACE (created_at + INTERVAL '1' HOUR AS created_at, {changed}),
      {_SECOND_OFFSET} + event_id AS ingest_seq
    FROM (SELECT {base} FROM {source}) WHERE {_SECOND_DELIVERY}"""


def _duckdb_select(columns: dict[str, str], source: str) -> str:
    return _duckdb(f"SELECT {', '.join(_select(columns))} FROM {source}")


DUCKDB_VIEWS = {
    "taps": _duckdb_deliveries(_TAPS, _TAPS_AGAIN, "events"),
    "trip_table": f"SELECT * EXCLUDE event_id FROM ({_duckdb_deliveries(_TRIPS, _TRIPS_AGAIN, 'events')})",
    "rider_table": _duckdb_select(_RIDERS, "customer"),
    "stop_table": _duckdb_select(_STOPS, "supplier"),
    "route_table": "SELECT DISTINCT * FROM ("
    + _duckdb_select(
        {"route_id": _TAPS["corridorID"], "route_name": _TAPS["corridorName"]}, "events"
    )
    + ") WHERE route_id IS NOT NULL",
    "feedback_table": "SELECT * EXCLUDE event_id FROM ("
    + _duckdb_deliveries(_FEEDBACK, _FEEDBACK_AGAIN, "orders")
    + ")",
}
