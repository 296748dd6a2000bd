"""Column expressions: means, buckets, parsing, unit conversions."""

from tempora.functions.buckets import REFERENCE_PERIODS, decade, period
from tempora.functions.means import mean
from tempora.functions.parsing import as_column, parse_date, parse_double, parse_timestamp
from tempora.functions.units import (
    default,
    first_element,
    kelvin_to_celsius,
    ms_to_kmh,
    pa_to_hpa,
    wind_bearing,
    wind_speed,
)

__all__ = [
    "REFERENCE_PERIODS",
    "as_column",
    "decade",
    "default",
    "first_element",
    "kelvin_to_celsius",
    "mean",
    "ms_to_kmh",
    "pa_to_hpa",
    "parse_date",
    "parse_double",
    "parse_timestamp",
    "period",
    "wind_bearing",
    "wind_speed",
]
