"""Time the batch job: raw CSV to staging Parquet, and staging to the marts of all pages.

    python -m checks.job_times [data_dir]

The raw CSV files are first written from the given tables to a new temporary folder.
"""

from __future__ import annotations

import statistics
import sys
import tempfile
import time

from mercato import pipeline
from mercato.schemas import RAW_FILES
from mercato.session import build_session
from mercato.sources import files, star

RUNS = 3


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "job", "local[8]", 8, {"spark.driver.memory": "8g", "spark.log.level": "ERROR"}
    )
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name, df in star.raw_tables(spark, data_dir).items():
        path = f"{home}/raw/{RAW_FILES[name].replace('*', 'shop')}"
        files.write_table(df, path, fmt="csv")

    times: dict[str, list[float]] = {"stage": [], "marts": []}
    for run in range(RUNS + 1):
        out = f"{home}/out{run}"
        begin = time.perf_counter()
        tables = pipeline.stage(spark, f"{home}/raw", out)
        staged = time.perf_counter()
        pipeline.write_marts(spark, tables, f"{out}/marts")
        done = time.perf_counter()
        if run:  # the first run warms up
            times["stage"].append(staged - begin)
            times["marts"].append(done - staged)
    for step, measured in times.items():
        print(step, round(statistics.median(measured), 2), [round(t, 2) for t in measured])
    spark.stop()


if __name__ == "__main__":
    main()
