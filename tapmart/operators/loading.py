"""What to load: rows and members that are not stored yet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.operators.facts import DROP_REQUIRED_FILL_OPTIONAL, build_fact


def skip_existing(rows: DataFrame, stored: DataFrame, key: str = "trip_id") -> DataFrame:
    """Rows whose id is not stored.

    First the stored ids that also occur in the batch are picked, then those are excluded. In
    this form the batch, not the whole stored table, is the side that may be broadcast, so a
    small batch is checked against a very large table in one scan of its id column.
    """
    ids = rows.select(key)
    known = stored.select(key).join(ids, key, "left_semi")
    return rows.join(known, key, "left_anti")


def resync_fact(
    staged: DataFrame,
    stored_dimensions: Mapping[str, DataFrame],
    source: str | Column,
    batch_id: str,
    loaded_at: Column | None = None,
) -> DataFrame:
    """A fact whose keys come from the stored dimensions.

    The staged rows carry their natural keys, so this is the same look-up as any other, with
    the optional keys set to unknown where they miss.
    """
    policy = DROP_REQUIRED_FILL_OPTIONAL
    return build_fact(staged, stored_dimensions, policy, source, batch_id, loaded_at=loaded_at)
