"""Analyses over the clean table: grouped means, rankings, outliers, trends.

Every aggregate is partial-then-final (map-side combine), so a key holding a
large share of the rows is collapsed before the shuffle. Top-k uses
``orderBy(...).limit(k)``, which plans as ``TakeOrderedAndProject`` (per
partition top-k, then a k-row merge), never a global sort. Rankings append
the group keys as a tiebreak so the cut is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions.buckets import REFERENCE_PERIODS, decade, period
from tempora.functions.means import mean
from tempora.functions.parsing import as_column

# The reference's extreme-temperature bounds (strict) and the
# minimum group size for city rankings (strict ">").
EXTREME_LOW = -20.0
EXTREME_HIGH = 40.0
MIN_CITY_RECORDS = 100
TOP_K = 10


def _measures(value: str, exact: bool, with_uncertainty: str | None = None) -> list[Column]:
    cols = [mean(value, exact=exact).alias("avg_temperature")]
    if with_uncertainty is not None:
        cols.append(mean(with_uncertainty, exact=exact).alias("avg_uncertainty"))
    cols.append(F.count(F.lit(1)).alias("num_records"))
    return cols


def mean_by(clean: DataFrame, keys: list[str], value: str = "temperature", exact: bool = False,
            uncertainty: str | None = None) -> DataFrame:
    """Rounded mean and row count per key."""
    return clean.groupBy(*keys).agg(*_measures(value, exact, uncertainty))


def mean_by_country(clean: DataFrame, k: int = TOP_K, exact: bool = False, country: str = "country",
                    value: str = "temperature", uncertainty: str = "uncertainty") -> DataFrame:
    """Top ``k`` countries by rounded mean temperature, with mean uncertainty and rows."""
    by = mean_by(clean, [country], value, exact, uncertainty)
    return by.orderBy(F.desc("avg_temperature"), F.asc(country)).limit(k)


def mean_by_year(clean: DataFrame, exact: bool = False, value: str = "temperature") -> DataFrame:
    """Mean and rows per year, ordered by year (a bounded result)."""
    return mean_by(clean, ["year"], value, exact).orderBy("year")


def first_years(by_year: DataFrame, n: int = TOP_K) -> DataFrame:
    return by_year.orderBy(F.asc("year")).limit(n)


def last_years(by_year: DataFrame, n: int = TOP_K) -> DataFrame:
    return by_year.orderBy(F.desc("year")).limit(n)


def city_means(clean: DataFrame, min_records: int = MIN_CITY_RECORDS, exact: bool = False,
               city: str = "city", country: str = "country", value: str = "temperature") -> DataFrame:
    """Mean per (city, country), keeping groups with more than ``min_records`` rows.

    Computed once; ``hottest`` and ``coldest`` rank the same result."""
    return mean_by(clean, [city, country], value, exact).filter(F.col("num_records") > min_records)


def hottest(means: DataFrame, k: int = TOP_K, city: str = "city", country: str = "country") -> DataFrame:
    return means.orderBy(F.desc("avg_temperature"), F.asc(city), F.asc(country)).limit(k)


def coldest(means: DataFrame, k: int = TOP_K, city: str = "city", country: str = "country") -> DataFrame:
    return means.orderBy(F.asc("avg_temperature"), F.asc(city), F.asc(country)).limit(k)


def mean_by_month(clean: DataFrame, exact: bool = False, value: str = "temperature") -> DataFrame:
    """Seasonality: mean per calendar month over all years."""
    return mean_by(clean, ["month"], value, exact).orderBy("month")


def is_extreme(value="temperature", low: float = EXTREME_LOW, high: float = EXTREME_HIGH) -> Column:
    """Strictly outside ``[low, high]``."""
    v = as_column(value)
    return (v < low) | (v > high)


def global_stats(clean: DataFrame, low: float = EXTREME_LOW, high: float = EXTREME_HIGH,
                 exact: bool = False, value: str = "temperature") -> DataFrame:
    """One row: global mean (2 dp), min, max and the number of extreme rows; one scan."""
    return clean.agg(
        mean(value, exact=exact).alias("global_mean_temperature"),
        F.min(value).alias("global_min_temperature"),
        F.max(value).alias("global_max_temperature"),
        F.count_if(is_extreme(value, low, high)).alias("extreme_observations"),
    )


EXTREME_COLUMNS = ["date", "city", "country", "temperature", "latitude", "longitude"]


def extremes(clean: DataFrame, low: float = EXTREME_LOW, high: float = EXTREME_HIGH,
             columns: list[str] = EXTREME_COLUMNS, value: str = "temperature") -> DataFrame:
    """Extreme rows, highest first, ties by the other columns: a frequent value
    can be split over several ranges. The sort covers only the (filtered) extremes."""
    return clean.filter(is_extreme(value, low, high)).select(*columns).orderBy(*_extreme_order(columns, value, True))


def _extreme_order(columns: list[str], value: str, descending: bool) -> list[Column]:
    first = F.desc(value) if descending else F.asc(value)
    return [first] + [F.asc(c) for c in columns if c != value]


def extremes_high(clean: DataFrame, k: int = TOP_K, low: float = EXTREME_LOW, high: float = EXTREME_HIGH,
                  columns: list[str] = EXTREME_COLUMNS, value: str = "temperature") -> DataFrame:
    """``k`` highest extreme rows, built from the unsorted filter (top-k, no full sort)."""
    rows = clean.filter(is_extreme(value, low, high)).select(*columns)
    return rows.orderBy(*_extreme_order(columns, value, True)).limit(k)


def extremes_low(clean: DataFrame, k: int = TOP_K, low: float = EXTREME_LOW, high: float = EXTREME_HIGH,
                 columns: list[str] = EXTREME_COLUMNS, value: str = "temperature") -> DataFrame:
    rows = clean.filter(is_extreme(value, low, high)).select(*columns)
    return rows.orderBy(*_extreme_order(columns, value, False)).limit(k)


def mean_by_period(clean: DataFrame, buckets=REFERENCE_PERIODS, exact: bool = False,
                   value: str = "temperature") -> DataFrame:
    """Mean per half-open period; rows outside every period are dropped before grouping."""
    tagged = clean.withColumn("period", period("year", buckets)).filter(F.col("period").isNotNull())
    return mean_by(tagged, ["period"], value, exact).orderBy("period")


def mean_by_decade(clean: DataFrame, exact: bool = False, value: str = "temperature") -> DataFrame:
    return mean_by(clean.withColumn("decade", decade("year")), ["decade"], value, exact).orderBy("decade")


def yearly_means(parsed: DataFrame, exact: bool = False, city: str = "City", country: str = "Country",
                 value: str = "temperature", source: str = "batch", with_grain: bool = False) -> DataFrame:
    """The batch job's core: mean per (City, Country, year), tagged with its source.

    ``parsed`` is the output of ``parse_history`` (or the clean table with the
    matching names). Invalid rows are dropped first. ``with_grain`` adds ``n``,
    the number of measurements behind each mean."""
    kept = parsed.filter(
        F.col(value).isNotNull() & F.col(city).isNotNull() & F.col(country).isNotNull() & F.col("year").isNotNull()
    )
    measures = [mean(value, exact=exact).alias("temperature_moyenne")]
    if with_grain:
        measures.append(F.count(F.lit(1)).alias("n"))
    return kept.groupBy(city, country, "year").agg(*measures).withColumn("source", F.lit(source))
