"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query once to warm up, then ``BENCH_REPEAT`` (default 3)
times, and prints one JSON line with the median seconds per query and
their sum.  A query is executed in full with the ``noop`` sink, so no
rows travel to Python.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderflow.plans.registry import QUERIES  # noqa: E402
from orderflow.session import get_spark  # noqa: E402

HEADLINE = [
    "silver_order_items",
    "gold_order_header",
    "gold_brand_sales_plain",
    "gold_hourly_plain",
    "delivery_percentiles",
    "refund_decisions",
    "stream_hourly_windowed_append",
    "completed_orders",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="orderflow-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    times: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        runs = [run_once(spark, name, sf_dir) for _ in range(repeat)]
        times[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {times[name]}s {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
