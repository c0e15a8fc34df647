"""What became of the batches of a stream: begun, or done."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import functions as F

from tapmart.sinks.warehouse import Warehouse
from tapmart.sources.tables import path_exists

LEDGER = "_ledger"
_STREAM_FILE = "_stream_id"


@dataclass(frozen=True)
class Batch:
    """A batch that was begun, with the highest key of every dimension at that time."""

    number: int
    keys: Mapping[str, int]
    done: bool


@dataclass(frozen=True)
class Ledger:
    """An intent and a commit per batch of a stream, one small JSON file each.

    An intent is written once, before anything of the batch is stored, so it tells a later run what
    the warehouse was like then. ``spark.read.json`` on the folder gives all of them as rows.
    """

    warehouse: Warehouse
    stream: str

    def _path(self, number: int, state: str) -> str:
        root = self.warehouse.root.rstrip("/")
        return f"{root}/{LEDGER}/stream={self.stream}/{number}-{state}.json"

    def find(self, number: int) -> Batch | None:
        spark, intent = self.warehouse.spark, self._path(number, "intent")
        if not path_exists(spark, intent):
            return None
        keys = json.loads(self.warehouse.read_small(intent))["keys"]
        return Batch(number, keys, path_exists(spark, self._path(number, "commit")))

    def begin(self, number: int) -> Batch:
        """The batch as it was begun first, by this run or by one that was stopped."""
        found = self.find(number)
        if found:
            return found
        batch = Batch(number, highest_keys(self.warehouse), False)
        self._write(number, "intent", keys=dict(batch.keys))
        return batch

    def commit(self, number: int, rows: Mapping[str, int]) -> None:
        self._write(number, "commit", rows=dict(rows))

    def _write(self, number: int, state: str, **more) -> None:
        row = {"batch": number, "state": state, **more}
        self.warehouse.put_small(self._path(number, state), json.dumps(row))


def highest_keys(warehouse: Warehouse) -> dict[str, int]:
    """The highest key of every stored dimension, by table."""
    found = None
    for name, frame in warehouse.star().items():
        if name != "fact":
            key = F.coalesce(F.max(f"{name}_key"), F.lit(0)).cast("bigint")
            row = frame.agg(F.lit(f"dim_{name}").alias("name"), key.alias("key"))
            found = row if found is None else found.union(row)
    return {r["name"]: r["key"] for r in found.collect()} if found is not None else {}


def stream_id(warehouse: Warehouse, checkpoint: str) -> str:
    """The id of the stream that has this checkpoint; it is made with the checkpoint, and so a
    lost checkpoint begins a new stream."""
    path = f"{checkpoint.rstrip('/')}/{_STREAM_FILE}"
    if not path_exists(warehouse.spark, path):
        warehouse.put_small(path, uuid.uuid4().hex)
    return warehouse.read_small(path)
