"""Compare a registered query with its oracle SQL: names, types, rows."""

from __future__ import annotations

import duckdb
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.BooleanType: "BOOLEAN",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def spark_type(data_type) -> str:
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    return SPARK_TYPES[type(data_type)]


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, connection, sql: str) -> list[str]:
    """What differs, in words; empty when all agrees."""
    names = sorted(df.columns)
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    oracle_types = {row[0]: row[1] for row in described}
    if sorted(oracle_types) != names:
        return [f"columns {names} against {sorted(oracle_types)}"]
    found = []
    for field in df.schema.fields:
        if spark_type(field.dataType) != oracle_types[field.name]:
            found.append(
                f"type of {field.name}: {spark_type(field.dataType)} "
                f"against {oracle_types[field.name]}"
            )
    ours = _sorted(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    columns = ", ".join(f'"{n}"' for n in names)
    theirs = _sorted(connection.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} against {len(theirs)}")
    for a, b in zip(ours, theirs):
        if a != b:
            found.append(f"first difference: {dict(zip(names, a))} against {dict(zip(names, b))}")
            break
    return found
