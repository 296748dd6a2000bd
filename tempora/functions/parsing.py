"""Null-safe parsing: one bad value becomes null instead of failing the job.

Spark 4 runs with ANSI mode on, where ``to_date``, ``cast`` and
``to_timestamp`` raise on bad input. The ``try_`` forms restore the
null-on-error behaviour the data cleaning relies on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"


def as_column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def parse_date(col, fmt: str = DATE_FORMAT, dtype: T.DataType | None = None) -> Column:
    """Text → date; null when the text does not match ``fmt``.

    A column that already holds dates or timestamps (``dtype``) is only cast:
    no per-row formatting and parsing."""
    if dtype is not None and isinstance(dtype, _TEMPORAL):
        return as_column(col).cast(T.DateType())
    return F.try_to_date(as_column(col), fmt)


def parse_double(col) -> Column:
    """Any → double; null when not a number (a no-op on doubles)."""
    return as_column(col).try_cast(T.DoubleType())


def parse_timestamp(col, dtype: T.DataType | None = None) -> Column:
    """ISO text → timestamp (session zone); null on bad text.

    When the column already holds a timestamp (``dtype`` given and not a
    string) it is only cast to ``timestamp``; ``timestamp_ntz`` must become
    ``timestamp`` before it can carry a watermark.
    """
    c = as_column(col)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.cast(T.TimestampType())
    return F.try_to_timestamp(c)
