"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.  Every
query runs once to warm up and then BENCH_RUNS times; the median counts.  Results
go to the noop sink, so whole rows are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from changeflow.plans.queries import QUERIES

HEADLINE = [
    "changes_between",
    "current_snapshot",
    "latest_by_key",
    "apply_changes_scd1",
    "apply_changes_scd2",
    "scd2_step",
    "scd2_effect",
    "pair_images",
    "snapshot_diff",
    "merge_state",
    "as_of_dimension",
    "incremental_aggregate",
    "feed_enabled_ranges",
    "feed_health",
    "gap_repair",
    "write_partitioned_history",
    "reconcile",
    "view_secured",
    "verify_row_filter",
    "stream_apply_scd1",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("changeflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
