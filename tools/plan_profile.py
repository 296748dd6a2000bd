"""Per-query profile from Spark's event log (the UI stays off).

Runs every registered query once to warm up, then $PROFILE_RUNS times, with
an event log in a fresh scratch folder; reports per query the median wall
time, file scans and exchanges in the executed plan, shuffle bytes written and
output files/bytes read back from the event log. Prints a Markdown table.

    python tools/plan_profile.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tempora.plans import catalog  # noqa: E402

RUNS = int(os.environ.get("PROFILE_RUNS", "5"))


def session(log_dir: str, cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tempora-profile")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plan_counts(df) -> tuple[int, int]:
    """Scans and exchanges in the final (post-AQE) plan; runs the DataFrame's
    own plan through its RDD, so nothing is collected."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    p = plan.toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan|Scan parquet|Scan csv|Scan json", p)), p.count("Exchange ")


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job description (the query key)."""
    job_desc, stage_job, out = {}, {}, {}
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    job_desc[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    written = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    desc = job_desc.get(stage_job.get(ev.get("Stage ID")))
                    if desc:
                        out[desc] = out.get(desc, 0) + written
    return out


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="tempora-eventlog-")
    spark = session(log_dir, cpus)
    rows = []
    for key, fn in catalog.QUERIES.items():
        spark.sparkContext.setJobDescription(f"warm:{key}")
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times = []
        for i in range(RUNS):
            spark.sparkContext.setJobDescription(key if i == 0 else f"run:{key}")
            if key == "unified":
                catalog._UNIFIED_BASES.clear()
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        scans, exchanges = plan_counts(df)
        rows.append((key, statistics.median(times), scans, exchanges))
    spark.sparkContext.setJobDescription(None)
    version = spark.version
    spark.stop()
    sbytes = shuffle_bytes(log_dir)
    print(f"sf_dir={sf_dir} cpus={cpus} runs={RUNS} spark={version} shuffle.partitions={cpus} (AQE on)")
    print("| query | median s | scans in plan | exchanges in plan | shuffle bytes (one run, incl. setup) |")
    print("| --- | ---: | ---: | ---: | ---: |")
    for key, t, scans, ex in rows:
        print(f"| `{key}` | {t:.3f} | {scans} | {ex} | {sbytes.get(key, 0):,} |")
    print(f"| **sum** | {sum(r[1] for r in rows):.2f} | | | |")


if __name__ == "__main__":
    main(sys.argv)
