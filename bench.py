"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then RUNS times into a sink that keeps nothing; the figure
is the median. The stream queries include starting the query, checkpoints and files.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from signalmill.plans.queries import QUERIES
from signalmill.session import configure

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "window_aggregate",
    "last_state",
    "core",
    "orphan_report",
    "latest_status",
    "status_list",
    "status_by_id",
    "health",
    "snapshot_diff",
    "rate_gaps",
    "lag_p95",
    "dq_unique_grain",
    "event_valid",
    "invalid_rate",
    "landing_upsert",
    "core_merge",
    "stream_window_aggregate",
    "stream_routing",
)


def seconds(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("signalmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": rows,
                "stream_rows_per_sec": round(rows / times["stream_window_aggregate"]),
            }
        )
    )


if __name__ == "__main__":
    main()
