"""Session helpers: a local session for tests/bench and shared scratch locations.

Library functions never build their own session; the caller passes ``spark``.
Intermediate tables, stream checkpoints and round-trip outputs go under the
shared folder named by ``spark.checkpoint.dir`` so that they survive executor
loss on a cluster. Only in local mode, where all tasks share one machine, is a
folder made when that setting is missing; on a cluster its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tempora") -> SparkSession:
    """Session used by tests and ``bench.py``; the UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). When
    neither is set, a local session (tests) gets a fresh folder as its
    checkpoint dir; any other raises.
    """
    base = spark.conf.get(_CHECKPOINT_KEY, None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tempora-ckpt-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused, never cleared).
    Spark's writers and stream checkpoints create it on first use."""
    return f"{shared_dir(spark)}/tempora/{name}-{uuid.uuid4().hex[:12]}"
