"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once untimed to warm the JVM, then BENCH_RUNS times (default 1); the best
time counts. Results are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from callweave.catalog import QUERIES
from callweave.session import builder, stage_run

HEADLINE = [
    "scan_window", "left_join_map", "successor", "next_with_max_default", "followup_range",
    "scd_half_open", "scd_closed_last", "scd_by_tag", "match_last",
    "match_all", "any_key_membership", "entity_expansion", "first_per_group",
    "keep_best", "group_summary", "ordered_concat", "time_gap", "stable_id",
    "daily_match_rate", "replace_slice", "job_followup", "job_router_match",
    "job_combined_fact", "job_cascade_match", "job_call_rates",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        builder("bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for i in range(runs + 1):
            start = time.perf_counter()
            with stage_run(spark):  # its stages go with it
                QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
                took = time.perf_counter() - start
            if i:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(root).name.removeprefix("sf"), "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
