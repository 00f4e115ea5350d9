"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up, then three times; its time is the median. A run builds the query,
computes every row and column of the result and discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skylake.session import build_session, remove_scratch  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "mart_newdata_", "mart_newdata", "mart_next_3_days_stats", "dep_3d_top3_temperature", "get_stats_region_today",
    "get_entire_region_data", "archive_append_twice", "fuzzy_match_words", "flatten_jsonl", "chunk_locations",
    "name_keys", "dq_completeness",
]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
