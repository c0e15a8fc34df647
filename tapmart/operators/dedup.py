"""Keeping one row per key.

The row_number filters below are planned as a group limit on both sides of the shuffle, so each
map task sends at most one row per key: a key that holds a third of all rows costs its reducer
one row per map task, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sorted_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order. The order should be total per key."""
    keys = [key] if isinstance(key, str) else list(key)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def latest(
    df: DataFrame,
    key: str | Sequence[str],
    moment: str = "created_at",
    fallback: str = "tap_in_at",
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """The newest row per key by ``moment``, or by ``fallback`` where that column is absent."""
    column = moment if moment in df.columns else fallback
    return sorted_first(df, key, [F.col(column).desc(), *tie_break])


def first(df: DataFrame, key: str | Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The row that arrived first per key."""
    return sorted_first(df, key, [F.col(name).asc() for name in arrival])


def first_version(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    arrival: Sequence[str],
    preferred: Sequence[Column] = (),
    file_column: str | None = None,
) -> DataFrame:
    """One row per key out of very many: the preferred version, then the one that arrived first.

    With ``file_column``, an outer column of ``arrival``, the first file that has the key decides,
    and the preference is among the rows of that file.

    Attributes repeat with every row of a key, so the distinct versions are found by a hash
    aggregation first. It runs before the shuffle too and leaves a few rows per key there,
    however many rows the key has. ``preferred`` may use the attributes only.
    """
    *outer, last = arrival
    versions = df.groupBy(key, *attributes, *outer).agg(F.min(last).alias(last))
    by_file = [F.col(file_column).asc()] if file_column else []
    order = [*by_file, *preferred, *[F.col(name).asc() for name in arrival]]
    return sorted_first(versions, key, order).select(key, *attributes)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """U4."""
    return df.select(*columns).distinct()
