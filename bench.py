"""Time the headline queries; prints one JSON line.

Each query runs once to warm up, then BENCH_RUNS times into a sink that keeps
nothing; the median counts. The folder is $BENCH_SF_DIR, the cores $BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from changeloom.session import build_session
from changeloom.workloads.queries import QUERIES

HEADLINE = (
    "cdc_latest_by_natural_key",
    "cdc_apply_batches",
    "cdc_snapshot_diff",
    "silver_telemetry",
    "silver_laps",
    "silver_results",
    "gold_driver_season_summary",
    "gold_race_pace_comparison",
    "gold_sector_dominance",
    "gold_race_weekend_summary",
    "gold_dim_driver_scd2",
    "gold_mart_driver_race_result",
    "scd2_versions",
    "point_in_time_lookup",
    "scope_race",
    "refresh_race_pace_comparison",
    "merge_stored_results",
    "merge_stored_laps",
    "merge_results_1_percent",
    "merge_results_half",
    "asof_lookup_millis",
    "replay_due_times",
    "replay_gaps",
    "panel_coverage",
    "expect_grain",
    "normalize_laps",
    "stream_bronze_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
