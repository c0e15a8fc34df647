"""Folder ingest as a stream of files."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapmart import presets
from tapmart.plans.incremental import LoadResult, load_files
from tapmart.sinks.ledger import Ledger, stream_id
from tapmart.sinks.warehouse import Warehouse
from tapmart.sources.files import FORMATS

FILES_PER_BATCH = 1000
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    checkpoint: str,
    load_date: Callable[[], Column],
    files_per_batch: int = FILES_PER_BATCH,
    reference_year: int = presets.REFERENCE_YEAR,
    on_batch: Callable[[LoadResult], None] | None = None,
    continuous: str | None = None,
    multi_line: bool = False,
    batch_prefix: str = "stream",
    time_formats: Sequence[str] = presets.TIME_FORMATS,
) -> StreamingQuery:
    """Load the files that arrived since the last run, then stop; or go on at an interval.

    The stream only finds files, their content is read by layout within each batch. A batch has
    a limited number of files, so its list of paths is short. The checkpoint tells which files
    were taken; should it be lost, files come again and add nothing. Batch ids are ``batch_prefix``,
    an id of the checkpoint, and the batch's number.

    A ledger in the warehouse has every batch's intent and commit. Spark gives a batch again if it
    was stopped before its end: a committed one is then skipped, another one finished, with counts
    and log lines of the whole batch.
    """
    ledger = Ledger(warehouse, stream_id(warehouse, checkpoint))

    def load(batch: DataFrame, number: int) -> None:
        paths = [row["path"] for row in batch.select("path").collect()]
        wanted = [p for p in paths if os.path.splitext(p)[1].lower() in FORMATS]
        if not wanted:
            return
        begun = ledger.begin(number)
        if begun.done:
            return
        result = load_files(
            warehouse,
            wanted,
            f"{batch_prefix}-{ledger.stream[:12]}-{number}",
            load_date(),
            reference_year,
            multi_line,
            time_formats,
            begun.keys,
        )
        ledger.commit(number, result.rows)
        if on_batch:
            on_batch(result)

    found = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )
    writer = found.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=continuous).start()
    return writer.trigger(availableNow=True).start()
