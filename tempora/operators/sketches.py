"""Mergeable sketches of distinct values.

``distinct_sketches`` keeps one HyperLogLog sketch per key and column (a few
kilobytes, whatever the number of values). Sketches of later rows, or of other
roots, are merged, and any coarser count is estimated from them without reading
the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # relative error about 1.04 / 2^6 = 1.6 %
COLUMNS = ("City", "Country")
KEYS = ("source", "year")


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(unified: DataFrame, keys=KEYS, columns=COLUMNS, lg_k: int = LG_K) -> DataFrame:
    """One row per ``keys`` with a sketch of each column, named after it. Nulls don't count."""
    return unified.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in columns])


def merge_sketches(sketches: DataFrame, keys=(), columns=COLUMNS) -> DataFrame:
    """Sketches merged by coarser ``keys`` (none: one row)."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, keys=(), columns=COLUMNS, names=("nb_villes", "nb_pays")) -> DataFrame:
    """Estimated distinct counts by coarser ``keys``."""
    merged = merge_sketches(sketches, keys, columns)
    return merged.select(*keys, *[F.hll_sketch_estimate(c).alias(n) for c, n in zip(columns, names, strict=True)])
