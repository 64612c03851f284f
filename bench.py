"""Time every registered query and print one JSON line.

    BENCH_SF_DIR   data directory       (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads        (default: all)
    BENCH_RUNS     timed runs per query (default 3, the median counts)
    BENCH_QUERIES  comma-separated names (default: all)

Each query runs once untimed, then the timed runs write to Spark's ``noop`` sink, which
computes every row and collects none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.queries import all_queries  # noqa: E402
from mercato.session import build_session  # noqa: E402


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", 3))
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]

    spark = build_session(
        "bench", f"local[{cpus}]", cpus, {"spark.driver.memory": "8g", "spark.log.level": "ERROR"}
    )
    queries = all_queries()
    medians = {}
    for name in chosen or queries:
        def run(query=queries[name]) -> float:
            begin = time.perf_counter()
            query(spark, data_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begin

        run()
        medians[name] = round(statistics.median(run() for _ in range(runs)), 4)

    scale = re.search(r"sf([\d.]+)$", data_dir)
    print(
        json.dumps(
            {
                "metric": "median_query_time_total",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": float(scale.group(1)) if scale else None,
                "config": {
                    "spark": spark.version,
                    "master": f"local[{cpus}]",
                    "driver_memory": "8g",
                    "shuffle_partitions": cpus,
                    "adaptive": True,
                    "runs": runs,
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
