"""Row counts of the cleaning steps."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.operators.cleaning import trim_all
from tapmart.operators.dedup import first
from tapmart.operators.trips import type_file_rows


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and more, while the frame is used for something else.

    The result can be read from the observation after an action on the returned frame.
    """
    observation = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]]
    return df.observe(observation, *columns), observation


def observed_value(observation: Observation, name: str) -> int:
    """A metric counted so far. Where the optimizer found the frame to be empty there is none."""
    try:
        return observation.get.get(name) or 0
    except Py4JJavaError as error:
        if "NoSuchElementException" in str(error) or "empty" in str(error).lower():
            return 0
        raise


def observed_rows(observation: Observation) -> int:
    return observed_value(observation, "rows")


def validation_report(rows: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Rows read, complete, unique, kept and dropped, one line per step."""
    complete = F.lit(True)
    for name in presets.NOT_NULL_FILE_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    before = trim_all(rows).agg(
        F.count(F.lit(1)).alias("read"), F.count_if(complete).alias("complete")
    )
    # One scalar for both counts: the deduplication runs once.
    after = first(type_file_rows(rows, arrival), "trip_id", arrival).agg(
        F.struct(F.count(F.lit(1)).alias("unique"), F.count("tap_in_at").alias("kept")).alias("both")
    )
    counts = before.select("read", "complete", after.scalar().alias("both"))
    counts = counts.select("read", "complete", "both.unique", "both.kept")
    steps = ["read", "complete", "unique", "kept"]
    lines = [F.struct(F.lit(s).alias("step"), F.col(s).alias("rows")) for s in steps]
    dropped = F.struct(F.lit("dropped").alias("step"), (F.col("read") - F.col("kept")).alias("rows"))
    return counts.select(F.inline(F.array(*lines, dropped)))
