"""Unit conversions and wind vector maths as column expressions.

The reference converts one vendor record at a time in Python; here the same
formulas are JVM expressions over a whole table of landed payloads.
Rounding is Spark's HALF_UP ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora.functions.parsing import as_column

# Physical constants used by the conversions.
KELVIN_OFFSET = 273.15
PA_PER_HPA = 100.0
KMH_PER_MS = 3.6


def kelvin_to_celsius(k, decimals: int = 2) -> Column:
    return F.round(as_column(k) - F.lit(KELVIN_OFFSET), decimals)


def pa_to_hpa(p, decimals: int = 1) -> Column:
    return F.round(as_column(p) / F.lit(PA_PER_HPA), decimals)


def ms_to_kmh(v, decimals: int = 2) -> Column:
    return F.round(as_column(v) * F.lit(KMH_PER_MS), decimals)


def wind_speed(u, v) -> Column:
    """Speed from components, ``sqrt(u² + v²)``; null if a component is null."""
    u, v = as_column(u), as_column(v)
    return F.sqrt(u * u + v * v)


def wind_bearing(u, v) -> Column:
    """Bearing in whole degrees: ``(atan2(u, v)·180/π + 180) mod 360`` truncated;
    0 when both components are zero, null if one is null."""
    u, v = as_column(u), as_column(v)
    deg = F.pmod(F.atan2(u, v) * F.lit(180.0) / F.pi() + F.lit(180.0), F.lit(360.0))
    return F.when((u == 0) & (v == 0), F.lit(0)).otherwise(deg.cast("int"))


def first_element(arr) -> Column:
    """First array element; null when the array is missing or empty."""
    return F.try_element_at(as_column(arr), F.lit(1))


def default(col, value) -> Column:
    """Replace null by ``value`` (the reference's behaviour for missing fields)."""
    return F.coalesce(as_column(col), F.lit(value))
