"""An index of the stored trip ids: what a batch brings anew is told without reading the fact."""

from __future__ import annotations

from typing import TYPE_CHECKING, ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.session import freeze
from tapmart.sources.tables import path_exists

if TYPE_CHECKING:
    from tapmart.sinks.warehouse import Warehouse

# Ids that a bucket is made for, and a part of a filter; filters have this many bits per id.
BUCKET_IDS = 1 << 20
MIN_BUCKETS = 16
BITS_PER_ID = 10
HASHES = 5
# Ids of a batch that meet one filter at a time.
SLICE_IDS = 1 << 17


class TripIndex:
    """Trip ids by hash bucket, with Bloom filters for every bucket.

    ``trip_index`` has the ids, in a folder per bucket. ``trip_filters`` has, for every load that
    added ids, the filters of its buckets as rows of 64-bit words. Buckets are set by the number of
    trips when the index is built; loads that add more get several parts per bucket, so that no
    row and no group grows with the table.

    A file beside the index marks it as open while trips are added. Should a load be stopped in
    between, the next one finds the mark and builds the index anew from the stored fact.
    """

    IDS: ClassVar[str] = "trip_index"
    FILTERS: ClassVar[str] = "trip_filters"
    TABLES: ClassVar[tuple[str, ...]] = (IDS, FILTERS)

    def __init__(self, warehouse: Warehouse, fact: str = "fact_trip", key: str = "trip_id"):
        self.warehouse, self.fact, self.key = warehouse, fact, key

    # ---------------------------------------------------------------------------------- building
    @property
    def _mark(self) -> str:
        return f"{self.warehouse.path(self.IDS)}-open"

    def is_sound(self) -> bool:
        """Whether the index has all stored trips, and no others."""
        tables = all(self.warehouse.exists(table) for table in self.TABLES)
        return tables and not path_exists(self.warehouse.spark, self._mark)

    def open(self) -> None:
        """Trips are going to be added."""
        system, path = self.warehouse._system(self._mark)
        system.create(path, True).close()

    def close(self) -> None:
        system, path = self.warehouse._system(self._mark)
        system.delete(path, False)

    def rebuild(self) -> None:
        """Build the index from the stored fact, of which only the ids are read."""
        self.open()
        ids = self.warehouse.read(self.fact).select(self.key)
        count = ids.count()
        buckets = 1 << max(MIN_BUCKETS - 1, count // BUCKET_IDS).bit_length()
        self._write(ids, count, buckets, "overwrite")
        self.close()

    def add(self, ids: DataFrame, count: int) -> None:
        """Add the ids of trips that were stored since ``open``."""
        if count:
            self._write(ids.select(self.key), count, self._buckets(), "append")
        self.close()

    def _buckets(self) -> int:
        """The number of buckets, the same in all filters."""
        return self.warehouse.read(self.FILTERS).select("buckets").first()[0]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _write(self, ids: DataFrame, count: int, buckets: int, mode: str) -> None:
        ids = ids.withColumn("bucket", self._bucket(buckets))
        spread = ids.hint("rebalance", "bucket").write.mode(mode)
        spread.option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
            self.warehouse.path(self.IDS)
        )
        filters = self._filters(ids, count, buckets)
        filters.write.mode(mode).parquet(self.warehouse.path(self.FILTERS))

    def _positions(self, key: Column, bits: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(i)), bits) for i in range(1, HASHES + 1)]

    def _part(self, key: Column, parts: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(0)), parts).cast("int")

    def _filters(self, ids: DataFrame, count: int, buckets: int) -> DataFrame:
        """``bucket, buckets, part, parts, words``: a filter per bucket and part.

        Bits are set by adding them up with OR, before the shuffle too. Words without a bit come
        as zeros, so that a word's place in the array is its number.
        """
        parts = max(1, -(-count // (buckets * BUCKET_IDS)))
        words = max(1, -(-count * BITS_PER_ID // (buckets * parts * 64)))
        bits = F.lit(words * 64)
        at = F.explode(F.array(*self._positions(F.col(self.key), bits))).alias("at")
        part = self._part(F.col(self.key), F.lit(parts)).alias("part")
        hit = ids.select("bucket", part, at).select(
            "bucket",
            "part",
            F.shiftright("at", 6).cast("int").alias("word"),
            F.call_function(
                "shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int")
            ).alias("bits"),
        )
        places = ids.sparkSession.range(buckets * parts * words)
        empty = places.select(
            (F.col("id") % buckets).cast("int").alias("bucket"),
            (F.floor(F.col("id") / buckets) % parts).cast("int").alias("part"),
            F.floor(F.col("id") / (buckets * parts)).cast("int").alias("word"),
            F.lit(0).cast("bigint").alias("bits"),
        )
        filled = hit.union(empty).groupBy("bucket", "part", "word").agg(F.bit_or("bits").alias("bits"))
        listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
        rows = filled.groupBy("bucket", "part").agg(listed.alias("listed"))
        return rows.select(
            "bucket",
            F.lit(buckets).alias("buckets"),
            "part",
            F.lit(parts).alias("parts"),
            F.col("listed.bits").alias("words"),
        )

    # ----------------------------------------------------------------------------------- asking
    def possibly_stored(self, rows: DataFrame, count: int) -> DataFrame:
        """``bucket`` and id of those rows that a filter lets through: all stored ones, few others.

        The ids of a batch meet the filters of their bucket as lists, so a filter is handled once
        per list and not once per id.
        """
        buckets = self._buckets()
        slices = max(1, -(-count // (buckets * SLICE_IDS)))
        part = F.pmod(F.xxhash64(self.key, F.lit(-1)), F.lit(slices))
        asked = (
            rows.select(self.key, self._bucket(buckets).alias("bucket"), part.alias("_slice"))
            .groupBy("bucket", "_slice")
            .agg(F.collect_set(self.key).alias("_ids"))
        )
        filters = self.warehouse.read(self.FILTERS)
        words = F.col("words")

        def held(key: Column) -> Column:
            found = self._part(key, F.col("parts")) == F.col("part")
            for at in self._positions(key, F.size(words) * 64):
                word = F.get(words, F.shiftright(at, 6).cast("int"))
                bit = F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int"))
                found = found & (bit.bitwiseAND(F.lit(1)) == 1)
            return found

        met = asked.join(filters, "bucket")
        through = met.select("bucket", F.explode(F.filter("_ids", held)).alias(self.key))
        return through.distinct()

    def stored_ids(self, rows: DataFrame, count: int) -> DataFrame:
        """The ids of the rows that are stored.

        Only the buckets in which a filter lets an id through are read; their numbers, of which
        there are no more than buckets, come to the driver and prune the folders.
        """
        possible = freeze(self.possibly_stored(rows, count), "possibly-stored")
        wanted = [r["bucket"] for r in possible.select("bucket").distinct().collect()]
        index = self.warehouse.read(self.IDS).where(F.col("bucket").isin(wanted))
        return index.join(possible, ["bucket", self.key], "left_semi").select(self.key).distinct()
