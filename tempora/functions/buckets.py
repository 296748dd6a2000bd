"""Derived grouping keys: decade and period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora.functions.parsing import as_column

# The reference's three half-open periods (start, end, label);
# end None means open-ended.
REFERENCE_PERIODS = [
    (1900, 1950, "1900-1949"),
    (1950, 2000, "1950-1999"),
    (2000, None, "2000+"),
]


def decade(year) -> Column:
    """``(year / 10)`` truncated toward zero, times 10 (1999 → 1990)."""
    return (as_column(year) / 10).cast("int") * 10


def period(year, buckets=REFERENCE_PERIODS) -> Column:
    """Label of the half-open bucket holding ``year``; null outside every bucket."""
    y = as_column(year)
    expr = None
    for start, end, label in buckets:
        cond = y >= start if end is None else (y >= start) & (y < end)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
