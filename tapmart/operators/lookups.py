"""Dimension look-ups."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.presets import UNKNOWN_KEY

MissPolicy = Literal["unknown", "null", "drop"]


def look_up(
    rows: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    take: Mapping[str, str],
    miss: MissPolicy = "unknown",
    bounded: bool = False,
) -> DataFrame:
    """Add columns of the member whose natural key matches.

    ``on`` is (column of rows, natural key of the dimension); ``take`` maps dimension columns to
    new names, the surrogate key first. A row without a match keeps the unknown key, keeps null,
    or is dropped. Closed versions of a member do not take part.

    Only a dimension with a fixed limit on its rows (``bounded``) is broadcast by hint. The rest
    is left to the optimizer, which broadcasts a side whose known size is under its threshold,
    and otherwise shuffles and splits the partitions of hot keys (and of null) at run time.
    """
    left_key, natural_key = on
    if "is_current" in dimension.columns:
        dimension = dimension.where("is_current = 1")
    side = dimension.select(
        F.col(natural_key).alias("_natural"), *[F.col(c).alias(name) for c, name in take.items()]
    )
    if bounded:
        side = F.broadcast(side)
    how = "inner" if miss == "drop" else "left"
    found = rows.join(side, rows[left_key] == side["_natural"], how).drop("_natural")
    if miss == "unknown":
        key = next(iter(take.values()))
        found = found.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY)))
    return found
