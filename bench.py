"""Seconds per registered query: one warm-up, median of three runs, noop write.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line. Names as
arguments run only those queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from stageline.registry.queries import QUERIES
from stageline.session import build_session

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        run(name, spark, sf_dir)
        times = [run(name, spark, sf_dir) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(times), 3)
    report = {
        "metric": "total seconds, sum of per-query medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "spark": spark.version,
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
