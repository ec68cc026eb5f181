"""Timings of the headline queries: median of warm runs, each result forced by a `noop` write. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from martlab.session import build_session

HEADLINE = (
    "stress_test_input", "data_quality_summary", "stg_collaterals", "filter_pattern_analysis", "key_parity",
    "adherence_daily", "absenteeism_daily", "absenteeism_by_type", "event_intervals", "overlap_seconds",
    "filter_tree_nested", "coerce_timestamp", "run_checks", "apply_changes", "top_items", "survival_curve",
)
WARM_RUNS = 5


def timed(run) -> float:
    began = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timed(lambda: QUERIES["check_predicate"](spark, folder))  # starts the session's lazy parts
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(timed(lambda: QUERIES[name](spark, folder)), 3)
        warm[name] = round(statistics.median(timed(lambda: QUERIES[name](spark, folder)) for _ in range(WARM_RUNS)), 3)
    print(json.dumps({
        "metric": "total_warm_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "first_run": cold, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
