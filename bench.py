"""Headline queries, warm, on local cores. Prints one JSON line.

    BENCH_SF_DIR  input folder   (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads  (default 8)
    BENCH_RUNS    timed runs per query after one warm-up (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from subpulse.queries import QUERIES  # noqa: E402
from subpulse.session import build_session  # noqa: E402

HEADLINE = [
    "stg_subscribers", "stg_events_news", "daily_active", "daily_active_grouping_sets", "daily_active_incremental",
    "subscriber_health", "dq_report", "dq_scorecard", "column_tests", "drift_status", "late_domain_stats",
    "late_platform", "late_manifest", "reprocess_partitions", "weekly_active", "multi_product", "section_readers",
    "kpis",
]


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus, runs = int(os.environ.get("BENCH_CPUS", "8")), int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", cpus, "bench", {"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds_of_warm_headline_queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rpartition("sf")[2], "cpus": cpus}))


if __name__ == "__main__":
    main()
