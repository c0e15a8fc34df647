"""Time the headline queries and print one JSON line.

Every query runs from the raw tables to its last row, once to warm up and three times measured;
the median counts. Where a query writes intermediate tables, that is part of its time.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from tapmart.queries import QUERIES
from tapmart.session import build_session

HEADLINE = (
    "q1_daily_trend",
    "q1_rollup",
    "q2_corridor_bank",
    "q3_hour_direction",
    "q4_rider_profile",
    "q5_top_stops",
    "fact_full",
    "fact_strict",
    "fact_from_flat",
    "fact_skip_existing",
    "clean_file_rows",
    "dedup_lineitem",
    "dense_key",
    "dim_rider",
    "dim_stop_union",
)
ROUNDS = 3


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", ROUNDS))
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tapmart-bench-"),
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        measured = [run(spark, name, sf_dir) for _ in range(rounds)]
        seconds[name] = round(statistics.median(measured), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
