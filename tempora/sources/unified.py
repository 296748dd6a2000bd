"""Unified table: one root per producer, read as one DataFrame.

A streaming file sink keeps a ``_spark_metadata`` log in its root and a read
of that root lists only committed files; anything else written into the same
root would be hidden. So batch and streaming results live under separate
roots and are combined with ``unionByName`` on read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.schemas import UNIFIED

BATCH = "batch"
STREAMING = "streaming"


def root_of(base: str, source: str) -> str:
    return f"{base}/{source}"


def _try_read(spark: SparkSession, path: str, may_be_empty: bool) -> DataFrame | None:
    """The table at ``path``; None where there is none. A streaming root exists
    before its first commit (``may_be_empty``); a batch root without files is a
    failed write, and an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or may_be_empty and "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


GRAIN = [("window_start", "timestamp"), ("n", "long")]


def read_unified(spark: SparkSession, base: str, sources=(BATCH, STREAMING), fallbacks=(),
                 with_grain: bool = False) -> DataFrame:
    """Union of every existing source root under ``base``; the first existing
    fallback base is tried when ``base`` has none. Empty (typed) when nothing exists.

    ``with_grain`` also returns ``window_start`` and ``n`` (null where a root
    was written without them), for means weighted by measurement counts."""
    def shape(p):
        cols = [p[f.name].cast(f.dataType).alias(f.name) for f in UNIFIED.fields]
        if with_grain:
            cols += [(p[c] if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in GRAIN]
        return p.select(*cols)

    for candidate in (base, *fallbacks):
        parts = [_try_read(spark, root_of(candidate, s), s == STREAMING) for s in sources]
        parts = [shape(p) for p in parts if p is not None]
        if parts:
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out
    empty = spark.createDataFrame([], UNIFIED)
    return shape(empty) if with_grain else empty
