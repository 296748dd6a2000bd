"""Partitioning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Repartition only when ``df`` plans fewer partitions than the cluster
    runs tasks at once (``defaultParallelism``).

    For CPU-heavy per-row work (JSON decoding) on an under-split input, such
    as one large row group. On a large input the planned partitions already
    exceed the parallelism and no shuffle is added.

    The decision belongs at the source and is taken from the scan's planned
    splits: a plan that holds an exchange is returned as it is, since asking it
    for its partitions would run it. The hash covers every column of ``df``, so
    project to the needed columns first (no pruning passes it)."""
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    # Hash of the row's own columns: deterministic on a retried task (unlike a
    # round-robin split, which needs a full local sort to be), and even unless
    # rows repeat massively.
    return df.repartition(target, F.xxhash64(*df.columns))
