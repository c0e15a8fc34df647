"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.llm.common import SPACES, whole
from tapmart.session import freeze

# Runs that meet in one merge. Every round replaces one digit, in this base, of the place of a run.
FAN = 4
_RUN = ["digest", "chars", "id", "row", "copies", "bytes", "proof"]
_RUN_SCHEMA = (
    "digest string, chars bigint, id bigint, row bigint, copies bigint, bytes bigint, "
    "proof bigint, place int, home int"
)


def normalised(text: Column) -> Column:
    """The text without any white space."""
    return F.translate(whole(text), SPACES, "")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest out of rows sorted by digest, the best first.

    Equal digests must agree in length and in a second, independent hash; a digest that stands for
    two texts fails the job instead of joining them. The last digest of a batch is held back, since
    the next batch may go on with it.
    """
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = table.combine_chunks()
        if table.num_rows == 0:
            continue
        digest = table["digest"].combine_chunks()
        starts = np.ones(len(digest), dtype=bool)
        starts[1:] = pc.not_equal(digest[1:], digest[:-1]).to_numpy(zero_copy_only=False)
        for name in ("bytes", "proof"):
            values = table[name].to_numpy()
            if ((values[1:] != values[:-1]) & ~starts[1:]).any():
                raise ValueError("two texts share a digest")
        first = np.flatnonzero(starts)
        copies = np.add.reduceat(table["copies"].to_numpy(), first)
        merged = table.take(pa.array(first))
        at = merged.schema.get_field_index("copies")
        merged = merged.set_column(at, merged.schema.field(at), pa.array(copies))
        held = merged.slice(merged.num_rows - 1)
        if merged.num_rows > 1:
            yield from merged.slice(0, merged.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.to_batches()


def _merge(runs: DataFrame) -> DataFrame:
    """Sort what a task has got, and merge it in one pass. The sort spills where it must."""
    best = [F.col("digest"), F.col("chars").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    return runs.sortWithinPartitions(*best).mapInArrow(_merged, _RUN_SCHEMA)


def merged_digests(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per digest over all partitions: who stays and how many rows have it.

    Partitions exchange runs in ``log_fan(places)`` rounds. In each round ``fan`` partitions whose
    places differ in one digit swap, so that each goes on with the digests of its own digit, and
    merges the runs it got into one. After the last round a digest is in one place only. A digest
    is one row per run from the first merge on, so a text that a third of all documents have
    costs a round ``fan`` rows, not a third of the data. The number of places follows
    ``spark.sql.shuffle.partitions``.
    """
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = max(1, math.ceil(math.log(max(wanted, 2), fan)))
    places = fan**rounds
    home = F.pmod(F.xxhash64("digest"), F.lit(places)).cast("int")
    place = F.pmod(F.spark_partition_id(), F.lit(places)).cast("int")
    runs = _merge(rows.select(*_RUN, place.alias("place"), home.alias("home")))
    for number in range(rounds):
        unit = fan**number

        def digit(column: str) -> Column:
            return F.floor(F.col(column) / unit).cast("int") % fan

        target = F.col("place") + (digit("home") - digit("place")) * unit
        moved = runs.withColumn("place", target.cast("int"))
        runs = _merge(moved.repartitionById(places, F.col("place")))
    return runs.select(*_RUN)


def exact_dedup(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", fan: int = FAN
) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are equal without their white space; null counts as empty. Of equal
    texts the row with the most code points stays, then the smallest id (null last), then one of
    rows that are repeated in whole. An empty table gives an empty table. Only id and text are
    read. Texts stay where they are; digests and ids travel. Telling every row the outcome is a
    join on the digest, whose hot values Spark splits.
    """
    plain = docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.char_length(whole(F.col(text))).cast("bigint").alias("chars"),
        normalised(F.col(text)).alias("_plain"),
    )
    rows = plain.select(
        "id",
        "chars",
        F.sha2(F.col("_plain").cast("binary"), 256).alias("digest"),
        F.octet_length("_plain").cast("bigint").alias("bytes"),
        F.xxhash64("_plain").alias("proof"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    rows = freeze(rows, "exact-digests")
    best = merged_digests(rows, fan).select(
        "digest",
        F.col("id").alias("keep_id"),
        F.col("row").alias("_keep_row"),
        F.col("copies").alias("group_size"),
    )
    return rows.select("id", "digest", "row").join(best, "digest").select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("_keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
