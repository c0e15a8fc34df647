"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart.session import freeze

# monotonically_increasing_id keeps the partition number above this bit and the row's place in
# the partition below it (fixed by Spark's documentation of the function).
_PARTITION_SHIFT = 33


def dense_key(
    df: DataFrame, key: str, order_by: Sequence[str], start: int | Column = 1, bounded: bool = False
) -> DataFrame:
    """SK1, SK2: number the rows ``start, start + 1, ...`` in the given order, without gaps.

    The order must be total. With ``bounded`` the caller states that the number of rows has a
    small fixed limit (a calendar); then one window over all rows does it, and nothing is written.

    Otherwise the rows are sorted across partitions by range and their place within the
    partition is recorded in the same pass. That table is written once (``freeze``), because
    range bounds are sampled and a second evaluation could cut elsewhere. How many rows lie
    before each partition is a single array with one number per partition, so that keying takes
    no join and the result keeps the known size of the table it reads. No step has all rows in
    one task.
    """
    first_key = F.lit(start) if isinstance(start, int) else start
    if bounded:
        position = F.row_number().over(Window.orderBy(*order_by))
        return df.withColumn(key, (first_key + position - 1).cast("int"))

    place = F.monotonically_increasing_id()
    numbered = freeze(df.orderBy(*order_by).withColumn("_place", place), f"key-{key}")
    part = F.shiftright("_place", _PARTITION_SHIFT).cast("int")
    row = F.col("_place").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    rows_before = _rows_before(numbered.groupBy(part.alias("part")).agg(F.max(row + 1).alias("size")))
    value = (first_key + F.get(rows_before.scalar(), part) + row).cast("bigint")
    return numbered.withColumn(key, value).drop("_place")


def _rows_before(sizes: DataFrame) -> DataFrame:
    """One array: at every partition number, the rows of the partitions before it.

    Partitions without rows count 0. The running sum goes over one row per partition.
    """
    last = F.sequence(F.lit(0), F.max("part"))
    empty = sizes.agg(F.explode(last).alias("part")).select("part", F.lit(0).alias("size"))
    filled = sizes.union(empty).groupBy("part").agg(F.sum("size").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    running = filled.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    listed = running.agg(F.array_sort(F.collect_list(F.struct("part", "before"))).alias("parts"))
    return listed.select(F.col("parts.before").alias("before"))


def append_keys(
    candidates: DataFrame,
    stored: DataFrame,
    key: str,
    natural_key: str,
    bounded: bool = False,
) -> DataFrame:
    """The members that are not stored yet, with keys going on after the stored ones.

    The unknown member's negative key does not count as a stored key.
    """
    known = stored.select(natural_key)
    fresh = candidates.join(known, natural_key, "left_anti")
    highest = stored.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).alias("highest"))
    start = F.lit(1) + highest.scalar()
    return dense_key(fresh, key, [natural_key], start=start, bounded=bounded)
