"""Writing to a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tapmart.sources.tables import JdbcTarget


def jdbc_write_options(
    target: JdbcTarget, table: str, batch_size: int = 1000, partitions: int | None = None
) -> dict[str, str]:
    """Options of one JDBC write; ``partitions`` limits the connections open at a time."""
    options = {**target.base_options(), "dbtable": table, "batchsize": str(batch_size)}
    return {**options, "numPartitions": str(partitions)} if partitions else options


def append_jdbc(df: DataFrame, target: JdbcTarget, table: str, **options) -> None:
    """K1."""
    writer = df.write.format("jdbc").options(**jdbc_write_options(target, table, **options))
    writer.mode("append").save()


def replace_jdbc(df: DataFrame, target: JdbcTarget, table: str, **options) -> None:
    """K2, K3: replace all rows but keep the table, with its keys and constraints."""
    writer = df.write.format("jdbc").options(**jdbc_write_options(target, table, **options))
    writer.option("truncate", True).mode("overwrite").save()
