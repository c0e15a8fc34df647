"""Parquet tables of the star schema under one folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapmart.operators.dimensions import dimension_schema, unknown_row, with_unknown
from tapmart.operators.reporting import observed, observed_rows
from tapmart.sinks.daily_sums import DailySums
from tapmart.sinks.trip_index import TripIndex
from tapmart.sources.tables import has_data, path_exists

FACT = "fact_trip"
DIMENSIONS = ("date", "stop", "route", "rider", "fleet", "feedback_category")
_GENERATIONS = "_generations"
_DIGITS = 12


@dataclass(frozen=True)
class Warehouse:
    """Tables by name. The fact is partitioned by travel date.

    Adding rows never rewrites what is stored: a write job puts whole files in place when it
    commits, and loading the same rows again is made harmless by the operators before it. One
    load writes at a time.

    A full load writes a new generation of folders. One small file per generation lists where
    every table is; the one with the highest number names the live generation, so a reader sees
    the tables before the load or those after it. Tables that no such file lists (all, before the
    first full load; the logs, always) lie under their own name. A generation that was replaced
    stays for those who still read it, until the next full load.
    """

    spark: SparkSession
    root: str
    pinned: tuple[tuple[str, str], ...] | None = None

    def path(self, table: str) -> str:
        live = self.live() if self.pinned is None else dict(self.pinned)
        return f"{self.root.rstrip('/')}/{live.get(table, table)}"

    def snapshot(self) -> Warehouse:
        """This warehouse with the tables of the generation that is live now, whatever comes."""
        pinned = tuple(self.live().items()) if self.pinned is None else self.pinned
        return replace(self, pinned=pinned)

    def exists(self, table: str) -> bool:
        return has_data(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def dimension(self, name: str) -> DataFrame:
        return self.read(f"dim_{name}")

    def star(self) -> dict[str, DataFrame]:
        """All stored dimensions, and the fact, of one generation."""
        here = self.snapshot()
        star = {n: here.dimension(n) for n in DIMENSIONS if here.exists(f"dim_{n}")}
        return {**star, "fact": here.read(FACT)} if here.exists(FACT) else star

    def trip_index(self) -> TripIndex:
        return TripIndex(self.snapshot(), FACT)

    def daily_sums(self) -> DailySums:
        return DailySums(self.snapshot(), FACT)

    def append(self, df: DataFrame, table: str) -> None:
        """K1."""
        df.write.mode("append").parquet(self.path(table))

    def replace(self, df: DataFrame, table: str) -> None:
        """K2. The new rows must not be read from the table itself."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            self.path(table)
        )

    def write_fact(self, fact: DataFrame, mode: str = "append") -> Observation:
        """Write facts by travel date, and count them.

        Rows are brought together by date before, so that a date gets few files; the rebalance
        hint lets Spark split a date that is too large for one task.
        """
        dated = fact.withColumn("travel_date", F.to_date("tap_in_at"))
        counted, observation = observed(dated.hint("rebalance", "travel_date"), FACT)
        writer = counted.write.mode(mode).option("partitionOverwriteMode", "static")
        writer.partitionBy("travel_date").parquet(self.path(FACT))
        return observation

    def load_all(self, dimensions: Mapping[str, DataFrame], fact: DataFrame) -> dict[str, int]:
        """K4, K5: a full load as a new generation; rows per table.

        All tables are written to a folder of their own, and then go live together. A failure or
        a stop at any step leaves what is live as it was. Dimensions that the load does not bring
        stay where they are, and those that the warehouse lacks come with their unknown member
        alone, so all of them have one.
        """
        generation = f"gen-{uuid.uuid4().hex}"
        staging = Warehouse(self.spark, f"{self.root.rstrip('/')}/{generation}")
        staged: dict[str, Observation] = {}
        for name in DIMENSIONS:
            if name in dimensions:
                frame = with_unknown(dimensions[name], name)
            elif not self.exists(f"dim_{name}"):
                frame = unknown_row(self.spark, name, dimension_schema(name))
            else:
                continue
            frame, staged[f"dim_{name}"] = observed(frame, f"dim_{name}")
            staging.replace(frame, f"dim_{name}")
        staged[FACT] = staging.write_fact(fact, mode="overwrite")
        counts = {table: observed_rows(observation) for table, observation in staged.items()}
        brought = "rider" in dimensions or not self.exists("dim_rider")
        staging.daily_sums().rebuild((staging if brought else self).dimension("rider"))
        staging.trip_index().rebuild()
        tables = [*staged, *DailySums.TABLES, *TripIndex.TABLES]
        self.go_live({table: f"{generation}/{table}" for table in tables})
        return counts

    # ------------------------------------------------------------------------------- generations
    def live(self) -> dict[str, str]:
        """Folder by table of the live generation."""
        numbers = self._numbers()
        return self._listed(numbers[-1]) if numbers else {}

    def go_live(self, folders: Mapping[str, str]) -> None:
        """Put the folders in place of those the tables have now, all at once."""
        numbers = self._numbers()
        before = self._listed(numbers[-1]) if numbers else {}
        number = numbers[-1] + 1 if numbers else 1
        after = {**before, **folders}
        self._publish(number, json.dumps(after, indent=1, sort_keys=True))
        self._tidy(before, after)

    def _numbers(self) -> list[int]:
        folder = f"{self.root.rstrip('/')}/{_GENERATIONS}"
        if not path_exists(self.spark, folder):
            return []
        system, path = self._system(folder)
        names = [status.getPath().getName() for status in system.listStatus(path)]
        return sorted(int(name) for name in names if name.isdigit())

    def _listed(self, number: int) -> dict[str, str]:
        return json.loads(
            self.read_small(f"{self.root.rstrip('/')}/{_GENERATIONS}/{number:0{_DIGITS}}")
        )

    def _publish(self, number: int, text: str) -> None:
        self.put_small(f"{self.root.rstrip('/')}/{_GENERATIONS}/{number:0{_DIGITS}}", text)

    def read_small(self, path: str) -> str:
        """The text of a small file."""
        system, hadoop_path = self._system(path)
        stream = system.open(hadoop_path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_small(self, path: str, text: str) -> None:
        """A new small file, written beside its place and then put there by a single rename."""
        folder, _, name = path.rpartition("/")
        system, beside = self._system(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = system.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if path_exists(self.spark, path) or not system.rename(beside, self._system(path)[1]):
            raise OSError(f"{path} was written meanwhile")

    def _tidy(self, before: Mapping[str, str], after: Mapping[str, str]) -> None:
        """Remove what neither the live generation nor the one before it has."""
        kept = {folder.split("/")[0] for folder in (*before.values(), *after.values())}
        kept |= {table for table in after if table not in before}
        system, root = self._system(self.root)
        for status in system.listStatus(root):
            name = status.getPath().getName()
            replaced = name.startswith("gen-") or (name in after and name not in kept)
            if replaced and name not in kept:
                system.delete(status.getPath(), True)

    def _system(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path
