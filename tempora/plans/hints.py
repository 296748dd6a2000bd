"""Physical hints the user controls."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tempora.operators.partitioning import spread  # noqa: F401  (re-exported hint)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache ``df`` for the block (worth it only with two or more consumers),
    spilling to disk rather than recomputing; always released afterwards."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
