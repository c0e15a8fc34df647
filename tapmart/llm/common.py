"""Helpers shared by the operators on documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six characters that count as white space in all contracts.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are. Pure ASCII takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def held_out(doc_id: Column, parts: int) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == 2


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the given values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def giving_back(run):
    """``run`` for a task; then memory that its worker no longer uses goes back to the system, as
    workers wait for their next task with all they have."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        pa.system_memory_pool().release_unused()

    return task
