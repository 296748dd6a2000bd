"""Throughput and state size of the registered event stream, from query progress.

    python tools/stream_stats.py [sf_dir] [runs]

Runs the windowed event stream (availableNow, whole `events` table) and prints
one JSON line per run: input rows, rows/s of the data batch, peak state rows,
state memory, and the number of micro-batches.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tempora.plans import catalog  # noqa: E402
from tempora.session import local_session, scratch_path  # noqa: E402
from tempora.streaming import queries as sq  # noqa: E402
from tempora.streaming import windows as sw  # noqa: E402


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 3
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    for _ in range(runs):
        df = sw.flatten_window(catalog._event_windows(spark, sf_dir))
        q = sq.start_parquet_append(df, scratch_path(spark, "stats-out"), scratch_path(spark, "stats-ckpt"),
                                    available_now=True)
        sq.run_to_completion(q)
        progress = q.recentProgress
        data = [p for p in progress if p["numInputRows"] > 0]
        state = [op for p in progress for op in p.get("stateOperators", [])]
        print(json.dumps({
            "input_rows": sum(p["numInputRows"] for p in progress),
            "rows_per_sec": round(max(p.get("processedRowsPerSecond", 0.0) for p in data), 1) if data else 0.0,
            "peak_state_rows": max((op["numRowsTotal"] for op in state), default=0),
            "final_state_rows": state[-1]["numRowsTotal"] if state else 0,
            "peak_state_bytes": max((op.get("memoryUsedBytes", 0) for op in state), default=0),
            "rows_dropped_by_watermark": sum(op.get("numRowsDroppedByWatermark", 0) for op in state),
            "micro_batches": len(progress),
            "duration_ms": sum(p["durationMs"].get("triggerExecution", 0) for p in progress),
        }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
