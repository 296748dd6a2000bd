"""Profiling and cleaning of the historical table.

One pass over the input: parsing is lazy, the filter merges into the scan's
stage, and row counts before/after come from an ``Observation`` attached to
the plan that is written anyway, instead of extra ``count()`` scans.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tempora.functions.parsing import as_column, parse_date, parse_double
from tempora.schemas import CLEAN_COLUMNS

# Column names of the historical CSV (fixed values of the input format).
RAW_DATE = "dt"
RAW_TEMPERATURE = "AverageTemperature"
RAW_UNCERTAINTY = "AverageTemperatureUncertainty"
RAW_CITY = "City"
RAW_COUNTRY = "Country"
RAW_LATITUDE = "Latitude"
RAW_LONGITUDE = "Longitude"


def null_profile(df: DataFrame) -> DataFrame:
    """One row: number of nulls in every column, named after the column."""
    return df.select([F.count(F.when(df[c].isNull(), F.lit(1))).alias(c) for c in df.columns])


def parse_history(raw: DataFrame, date: str = RAW_DATE, temperature: str = RAW_TEMPERATURE,
                  uncertainty: str = RAW_UNCERTAINTY, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add ``date, year, month, temperature, uncertainty``; bad text becomes null."""
    d = parse_date(date, fmt, raw.schema[date].dataType)
    return raw.withColumns(
        {
            "date": d,
            "year": F.year(d),
            "month": F.month(d),
            "temperature": parse_double(temperature),
            "uncertainty": parse_double(uncertainty),
        }
    )


def is_valid(city: str = RAW_CITY, country: str = RAW_COUNTRY) -> Column:
    """Row is kept: temperature, city, country and date all present (after parsing)."""
    return (
        F.col("temperature").isNotNull()
        & as_column(city).isNotNull()
        & as_column(country).isNotNull()
        & F.col("date").isNotNull()
    )


def to_clean_schema(parsed: DataFrame, city: str = RAW_CITY, country: str = RAW_COUNTRY,
                    latitude: str = RAW_LATITUDE, longitude: str = RAW_LONGITUDE) -> DataFrame:
    """Select and rename to the 9-column clean table."""
    return parsed.select(
        "date",
        "year",
        "month",
        "temperature",
        "uncertainty",
        F.col(city).alias("city"),
        F.col(country).alias("country"),
        F.col(latitude).alias("latitude"),
        F.col(longitude).alias("longitude"),
    )


def clean_history(raw: DataFrame, city: str = RAW_CITY, country: str = RAW_COUNTRY,
                  latitude: str = RAW_LATITUDE, longitude: str = RAW_LONGITUDE,
                  **parse_args) -> DataFrame:
    """Parse, drop invalid rows and shape to the clean table."""
    parsed = parse_history(raw, **parse_args)
    kept = parsed.filter(is_valid(city, country))
    return to_clean_schema(kept, city, country, latitude, longitude)


def observed_clean(raw: DataFrame, name: str = "clean", city: str = RAW_CITY, country: str = RAW_COUNTRY,
                   latitude: str = RAW_LATITUDE, longitude: str = RAW_LONGITUDE,
                   with_nulls: bool = False, **parse_args) -> tuple[DataFrame, Observation]:
    """Clean table plus an ``Observation`` filled by whichever action runs it.

    ``obs.get`` holds ``rows_before`` and ``rows_after`` once the clean table has
    been written (or otherwise fully consumed); no separate scan is needed.
    ``with_nulls`` also counts the nulls of every raw column (``observed_nulls``)."""
    obs = Observation(name)
    valid = is_valid(city, country)
    observed = parse_history(raw, **parse_args).observe(obs, *row_metrics(raw.columns if with_nulls else [], city, country))
    return to_clean_schema(observed.filter(valid), city, country, latitude, longitude), obs


def row_metrics(columns=(), city: str = RAW_CITY, country: str = RAW_COUNTRY) -> list[Column]:
    """Rows before and after cleaning, and the nulls of each of ``columns``, of a parsed table."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    return [F.count(F.lit(1)).alias("rows_before"), F.count_if(is_valid(city, country)).alias("rows_after"), *nulls]


def observed_counts(obs: Observation, parsed: DataFrame, metrics: list[Column]) -> dict:
    """The observed metrics. Where no row was left, Spark may have cut the observed
    part out of the plan, and with it the metrics: they are counted then."""
    try:
        found = dict(obs.get)
    except Py4JJavaError:
        found = {}
    return found if "rows_before" in found else parsed.agg(*metrics).first().asDict()


def observed_nulls(raw: DataFrame, counted: dict) -> DataFrame:
    """The null profile of ``raw`` from metrics that hold it: one row, no scan."""
    counts = tuple(counted[f"nulls_{i}"] for i in range(len(raw.columns)))
    schema = ", ".join(f"`{c}` long" for c in raw.columns)
    return raw.sparkSession.createDataFrame([counts], schema)


def half_up_percent(part: str, whole: str) -> Column:
    """``round(100 * part / whole, 2)`` HALF_UP in exact integer arithmetic; null if whole is 0.

    In longs whatever the columns' type: counts that came through the driver are
    int literals, whose products overflow at some 107,000 removed rows."""
    hundredths = F.expr(f"(2L * {part} * 10000 + {whole}) div (2L * {whole})")
    return F.when(F.col(whole) > 0, hundredths / F.lit(100.0))


def clean_counts(raw: DataFrame, city: str = RAW_CITY, country: str = RAW_COUNTRY, **parse_args) -> DataFrame:
    """One row: rows before and after cleaning, rows removed, removal percentage."""
    parsed = parse_history(raw, **parse_args)
    counts = parsed.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(is_valid(city, country)).alias("rows_after"),
    )
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")).withColumn(
        "removal_pct", half_up_percent("rows_removed", "rows_before")
    )


def table_shape(df: DataFrame) -> dict:
    """Column count and planned partition count (no job is run)."""
    return {"columns": len(df.columns), "partitions": df.rdd.getNumPartitions()}


__all__ = [
    "CLEAN_COLUMNS",
    "clean_counts",
    "clean_history",
    "half_up_percent",
    "is_valid",
    "null_profile",
    "observed_clean",
    "observed_counts",
    "observed_nulls",
    "parse_history",
    "row_metrics",
    "table_shape",
    "to_clean_schema",
]
