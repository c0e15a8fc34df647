"""Constraints as checks, since files of rows enforce none: each lists what breaks it.

Rows are counted per value first, so a value is compared once however many rows have it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Unique keys: the keys that more than one row has, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def dangling_keys(df: DataFrame, column: str, members: DataFrame, member_key: str) -> DataFrame:
    """Foreign keys: the values, null included, that no member has, with the number of rows."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = members.select(F.col(member_key).alias("_known"))
    return per_value.join(known, F.col(column) == F.col("_known"), "left_anti")


def values_outside(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Enumerations: the values, null included, that are not allowed, with the number of rows."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    is_allowed = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return per_value.where(~is_allowed)
