"""Session settings, and the shared folder for frozen intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

T = TypeVar("T")

# Settings the operators are written for. Joins are left to the optimizer: a side is broadcast
# when its known size is under the threshold, and skewed partitions of the remaining shuffle
# joins are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# While a table is frozen: its shuffles go when it is written, not when the driver collects garbage.
_FREEZING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# For rows that hold whole sets or texts: what a task hands to Python at once, outside of the
# JVM's heap.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_holders: dict[tuple[int, str], list] = {}
_holding = threading.Lock()


def build_session(app_name: str = "tapmart", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own; on a cluster a missing
    setting is an error, since a machine-local folder would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tapmart-"))
    return context.getCheckpointDir().rstrip("/")


@contextmanager
def held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the time of some work.

    Work side by side shares them: the first to come sets them, the last to go sets them back.
    """
    with _holding:
        for name, value in settings.items():
            holder = _holders.setdefault((id(spark), name), [0, spark.conf.get(name, None)])
            holder[0] += 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _holding:
            for name in settings:
                holder = _holders[id(spark), name]
                holder[0] -= 1
                if not holder[0]:
                    del _holders[id(spark), name]
                    if holder[1] is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, holder[1])


def freeze(
    df: DataFrame,
    name: str,
    folder: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a reader of it.

    Used where several consumers need one and the same evaluation. The reader prunes columns and
    knows the size of the table, so later joins are planned on facts. Losing an executor loses
    nothing: the table lies in shared storage. ``settings`` hold while it is written.
    """
    spark = df.sparkSession
    path = folder or f"{shared_folder(spark)}/tapmart/{name}-{uuid.uuid4().hex}"
    with held(spark, {**_FREEZING, **(settings or {})}):
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, work: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent pieces of work, each with jobs of its own, at the same time.

    Their small stages then share the cluster instead of waiting for one another.
    """
    if len(work) < 2:
        return {name: run() for name, run in work.items()}
    with ThreadPoolExecutor(len(work)) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(run)) for name, run in work.items()
        }
        return {name: future.result() for name, future in started.items()}
