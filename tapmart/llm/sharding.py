"""Sharding indivisible groups evenly by bytes: Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.llm.common import whole
from tapmart.operators.keys import dense_key
from tapmart.session import freeze

SHARDS = 24
OVERHEAD = 8
# Groups that one task differences at a time, and blocks that meet in one merge.
BLOCK = 32_768
MEET = 4_096


def difference(parts: Sequence[Sequence[int]], shards: int) -> list[list[int]]:
    """Where the parts of each partial partition go: a shard for every part of every entry.

    An entry is a partition of some groups into ``shards`` parts, given by their sizes; a single
    group is one part beside empty ones, for which the list may be cut short. The two entries of
    largest spread are combined, the largest part of one with the smallest of the other, until one
    is left. Only differences to the smallest part matter, so these are kept.
    """
    if not parts:
        return []
    heap = []
    orders: list[list[int]] = []
    for number, sizes in enumerate(parts):
        padded = [*sizes, *[0] * (shards - len(sizes))]
        order = sorted(range(shards), key=lambda i: -padded[i])
        ranked = [padded[i] for i in order]
        low = ranked[-1]
        heap.append((low - ranked[0], number, [value - low for value in ranked]))
        orders.append(order)
    heapq.heapify(heap)
    children: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        _, left, a = heapq.heappop(heap)
        _, right, b = heap[0]
        sums = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(shards), key=lambda i: -sums[i])
        low = sums[order[-1]]
        number = len(parts) + len(children)
        children.append((left, right, order))
        heapq.heapreplace(heap, (low - sums[order[0]], number, [sums[i] - low for i in order]))

    places: dict[int, list[int]] = {heap[0][1]: list(range(shards))}
    for at in range(len(children) - 1, -1, -1):
        left, right, order = children[at]
        placed = places.pop(len(parts) + at)
        own = [0] * shards
        for rank, index in enumerate(order):
            own[index] = placed[rank]
        places[left] = own
        places[right] = own[::-1]
    found = []
    for number, order in enumerate(orders):
        by_part = [0] * shards
        for rank, index in enumerate(order):
            by_part[index] = places[number][rank]
        found.append(by_part)
    return found


def _local_parts(shards: int):
    """Difference the groups of a partition, block by block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                block = batch.iloc[start : start + BLOCK]
                sizes = block["bytes"].tolist()
                placed = difference([[size] for size in sizes], shards)
                yield pd.DataFrame(
                    {
                        "group": block["group"].to_numpy(),
                        "bytes": block["bytes"].to_numpy(),
                        "block": (task << 24) + number,
                        "part": np.array([by_part[0] for by_part in placed], dtype="int32"),
                    }
                )
                number += 1

    return run


def _combine_blocks(shards: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        table = rows.pivot_table("bytes", "block", "part", "sum", fill_value=0)
        table = table.reindex(columns=range(shards), fill_value=0).sort_index()
        placed = difference([list(map(int, row)) for row in table.to_numpy()], shards)
        blocks = np.repeat(table.index.to_numpy(), shards)
        return pd.DataFrame(
            {
                "block": blocks,
                "part": np.tile(np.arange(shards, dtype="int32"), len(table)),
                "meeting": rows["meeting"].iloc[0],
                "shard": np.array(placed, dtype="int32").ravel(),
                "bytes": table.to_numpy().ravel().astype("int64"),
            }
        )

    return run


def assign_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group, shard`` for rows ``group, bytes`` with one row per group.

    A task differences its own groups, a bounded block at a time, and a block goes on as its
    ``shards`` sums only: that is an entry of the same method, so blocks are differenced in turn,
    up to ``MEET`` together, level by level until one entry is left. No task sees all groups.
    """
    spread = groups.repartition("group")
    local = freeze(
        spread.mapInPandas(
            _local_parts(shards), "group string, bytes bigint, block bigint, part int"
        ),
        "shard-parts",
    )
    sums = local.groupBy("block", "part").agg(F.sum("bytes").alias("bytes"))
    placed = local.select("group", "block", "part")
    while True:
        blocks = sums.select("block").distinct().count()
        meetings = max(1, -(-blocks // MEET))
        meeting = F.pmod(F.xxhash64("block"), F.lit(meetings))
        level = freeze(
            sums.withColumn("meeting", meeting)
            .groupBy("meeting")
            .applyInPandas(
                _combine_blocks(shards),
                "block bigint, part int, meeting bigint, shard int, bytes bigint",
            ),
            "shard-level",
        )
        placed = placed.join(level.drop("bytes"), ["block", "part"]).select(
            "group", F.col("meeting").alias("block"), F.col("shard").alias("part")
        )
        if meetings == 1:
            return placed.select("group", F.col("part").alias("shard"))
        sums = level.groupBy(F.col("meeting").alias("block"), F.col("shard").alias("part")).agg(
            F.sum("bytes").alias("bytes")
        )


def shard_by_bytes(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    shards: int = SHARDS,
    overhead: int = OVERHEAD,
) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``shard`` and ``slot``, its place in the shard.

    A row's size is the UTF-8 length of its text plus ``overhead``. Rows of equal text are one
    group and never parted; null and empty texts are equal. Groups are placed by differencing, so
    shards are about equal in bytes unless one group alone is larger than a shard's share. Slots
    count from 0 without gaps, by id (null first). An empty table gives an empty table.

    Texts are read once and stay where they are. The size of a group adds up before the shuffle.
    """
    content = whole(F.col(text))
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(content) + overhead).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.sha2(content.cast("binary"), 256).alias("group"),
    )
    rows = freeze(rows, "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    placed = rows.join(assign_groups(groups, shards), "group")
    numbered = dense_key(placed, "_position", ["shard", "id", "group"], start=0)
    first = numbered.groupBy("shard").agg(F.min("_position").alias("_first"))
    return numbered.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        "shard",
        (F.col("_position") - F.col("_first")).alias("slot"),
    )
