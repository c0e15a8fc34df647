"""Relational and columnar tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is. Credentials come from the caller and are kept out of the repr."""

    url: str
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def base_options(self) -> dict[str, str]:
        driver = {"driver": self.driver} if self.driver else {}
        return {"url": self.url, **driver, **self.options}


@dataclass(frozen=True)
class Split:
    """How a table is read by many tasks: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def jdbc_read_options(
    target: JdbcTarget,
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    fetch_size: int = 1000,
) -> dict[str, str]:
    """Options of one JDBC read of a whole table or of a sub-select run by the database."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {**target.base_options(), "fetchsize": str(fetch_size)}
    if split is None:
        return {**options, **({"dbtable": table} if table else {"query": query})}
    # Spark allows a split with a table or an aliased sub-select, not with the query option.
    return {**options, "dbtable": table or f"({query}) AS source_rows", **split.options()}


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    fetch_size: int = 1000,
) -> DataFrame:
    """S1, S2. Without a split a single task reads the table, so big tables need one."""
    options = jdbc_read_options(target, table, query, split, fetch_size)
    return spark.read.format("jdbc").options(**options).load()


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """S1, S2 on a columnar table: the filter and the column list reach the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(path)
    if where is not None:
        rows = rows.where(where)
    return rows.select(*columns) if columns else rows


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsc.hadoopConfiguration()
    return bool(hadoop_path.getFileSystem(configuration).exists(hadoop_path))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds data files that a write job has put in place.

    What a write job left behind when it was cut off does not count.
    """
    if not path_exists(spark, path):
        return False
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(hadoop_path).toString()
    found = system.listFiles(hadoop_path, True)
    while found.hasNext():
        inner = found.next().getPath().toString()[len(root) :].strip("/")
        if not any(name.startswith(("_", ".")) for name in inner.split("/")):
            return True
    return False


def optional_table(spark: SparkSession, name_or_path: str) -> DataFrame | None:
    """The table, or None where there is none. Other errors are raised."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path) if has_data(spark, name_or_path) else None
    return spark.table(name_or_path) if spark.catalog.tableExists(name_or_path) else None


def extract(readers: Mapping[str, Callable[[], DataFrame | None]]) -> dict[str, DataFrame]:
    """Named lazy frames; sources that are absent are left out."""
    frames = {name: read() for name, read in readers.items()}
    return {name: frame for name, frame in frames.items() if frame is not None}
