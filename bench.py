"""Benchmark: run the catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is materialised with the ``noop`` sink (full computation, nothing
collected to the driver). After one warm-up pass, every query runs
$BENCH_RUNS times and its median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tempora.plans import catalog  # noqa: E402
from tempora.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_once(spark, key: str) -> float:
    if key == "unified":
        catalog._UNIFIED_BASES.clear()  # time the build of both roots here
    t0 = time.perf_counter()
    materialise(catalog.QUERIES[key](spark, SF_DIR))
    return time.perf_counter() - t0


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=CPUS, app="tempora-bench")
    keys = ONLY or list(catalog.QUERIES)
    errors = {}
    for key in keys:  # warm-up: JIT, file listing caches, unified roots
        try:
            run_once(spark, key)
        except Exception as exc:  # reported, not fatal: the other queries still run
            errors[key] = str(exc).splitlines()[0][:300]
    timings = {}
    for key in keys:
        if key not in errors:
            timings[key] = round(statistics.median(run_once(spark, key) for _ in range(RUNS)), 4)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": CPUS,
        "runs": RUNS,
        "spark": spark.version,
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
