"""A mergeable pre-aggregate of the clean table, from which all summaries roll up.

For every (city, country, year, month) it keeps what a mean, a count and an
extreme need and what can be added up: the number of values, the two integer
sums of the exact mean (``functions/means.py``), how many values they cover,
the plain sum for groups that the exact mean can't hold, minimum and maximum.
Any coarser grouping is a sum of these rows, and the rows of a later increment
are merged by the same sums: the clean table need not be read again.

``means`` and the summaries give the same figures as the functions of
``operators/analysis.py`` over the clean table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.buckets import REFERENCE_PERIODS, decade, period
from tempora.functions.means import _SPLIT_BITS, fits_units, units
from tempora.operators.analysis import EXTREME_HIGH, EXTREME_LOW, MIN_CITY_RECORDS, TOP_K, is_extreme
from tempora.sinks import versions

KEYS = ("city", "country", "year", "month")
VALUES = ("temperature", "uncertainty")
_ADDED = ("n", "fit", "hi", "lo", "sum")


def value_state(value: str, scale: int = 2) -> list[Column]:
    """Aggregates of a value that can be added up, or compared, later (``merge``)."""
    c = F.col(value)
    fits = fits_units(c, scale)
    u = units(F.when(fits, c), scale)
    return [
        F.count(c).alias(f"{value}_n"),
        F.count_if(fits).alias(f"{value}_fit"),
        F.sum(F.shiftright(u, _SPLIT_BITS)).alias(f"{value}_hi"),
        F.sum(u.bitwiseAND(F.lit((1 << _SPLIT_BITS) - 1))).alias(f"{value}_lo"),
        F.sum(c).alias(f"{value}_sum"),
        F.min(c).alias(f"{value}_min"),
        F.max(c).alias(f"{value}_max"),
    ]


def preaggregate(clean: DataFrame, keys=KEYS, values=VALUES, low: float = EXTREME_LOW, high: float = EXTREME_HIGH, scale: int = 2) -> DataFrame:
    """One row per ``keys``: ``n_rows``, ``n_extreme`` (outside [low, high] in the
    first value) and the state of each value. One pass, combined map-side."""
    states = [c for v in values for c in value_state(v, scale)]
    return clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(is_extreme(values[0], low, high)).alias("n_extreme"), *states)


def slices(clean: DataFrame, sets: dict[str, tuple[str, ...]], values=VALUES, low: float = EXTREME_LOW, high: float = EXTREME_HIGH, scale: int = 2) -> DataFrame:
    """Several pre-aggregates, coarser than ``KEYS``, in one pass: a row per key of
    each set, told apart by ``slice`` (the set's name; keys of other sets are null)."""
    keys = list(dict.fromkeys(k for own in sets.values() for k in own))
    states = [c for v in values for c in value_state(v, scale)]
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count_if(is_extreme(values[0], low, high)).alias("n_extreme")]
    found = clean.groupingSets([[F.col(k) for k in own] for own in sets.values()], *keys).agg(F.grouping_id(*keys).alias("_id"), *counts, *states)
    name = F.create_map(*[F.lit(x) for n, own in sets.items() for x in (sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own), n)])
    return found.withColumn("slice", name[F.col("_id").cast("int")]).drop("_id")


def merge(pre: DataFrame, keys=KEYS) -> DataFrame:
    """Rows of a pre-aggregate (of one table, or of several put together) added
    up by ``keys``, the same or coarser ones."""
    how = {"min": F.min, "max": F.max} | dict.fromkeys(_ADDED, F.sum)
    states = [(c, F.sum if c.startswith("n_") else how.get(c.rpartition("_")[2])) for c in pre.columns]
    return pre.groupBy(*keys).agg(*[of(c).alias(c) for c, of in states if of is not None])


def mean_of(value: str, exact: bool = False, decimals: int | None = 2, scale: int = 2) -> Column:
    """The mean of a merged state, as ``functions.means.mean`` of the rows."""
    n = F.col(f"{value}_n")
    plain = F.when(n > 0, F.col(f"{value}_sum") / n)
    plain = plain if decimals is None else F.round(plain, decimals)
    if not exact:
        return plain
    if decimals is not None and decimals > scale:
        raise ValueError("decimals must not exceed scale for the exact mean")
    total = F.col(f"{value}_hi").cast("decimal(24,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(8,0)") + F.col(f"{value}_lo").cast("decimal(24,0)")
    total = total.cast("decimal(24,0)")
    if decimals is None:
        value_of = total.cast("double") / (n * F.lit(10**scale)).cast("double")
    else:
        value_of = F.round(total / n, decimals - scale).cast("double") / F.lit(float(10**scale))
    return F.when(F.col(f"{value}_fit") == n, F.when(n > 0, value_of)).otherwise(plain)


def means(pre: DataFrame, keys: list[str], exact: bool = False, value: str = "temperature", uncertainty: str | None = None) -> DataFrame:
    """Rounded mean and row count per key, coarser than (or as fine as) ``pre``."""
    columns = [mean_of(value, exact).alias("avg_temperature")]
    if uncertainty is not None:
        columns.append(mean_of(uncertainty, exact).alias("avg_uncertainty"))
    return merge(pre, keys).select(*keys, *columns, F.col("n_rows").alias("num_records"))


def mean_by_country(pre: DataFrame, k: int = TOP_K, exact: bool = False) -> DataFrame:
    return means(pre, ["country"], exact, uncertainty="uncertainty").orderBy(F.desc("avg_temperature"), F.asc("country")).limit(k)


def mean_by_year(pre: DataFrame, exact: bool = False) -> DataFrame:
    return means(pre, ["year"], exact).orderBy("year")


def mean_by_month(pre: DataFrame, exact: bool = False) -> DataFrame:
    return means(pre, ["month"], exact).orderBy("month")


def mean_by_decade(pre: DataFrame, exact: bool = False) -> DataFrame:
    return means(pre.withColumn("decade", decade("year")), ["decade"], exact).orderBy("decade")


def mean_by_period(pre: DataFrame, buckets=REFERENCE_PERIODS, exact: bool = False) -> DataFrame:
    tagged = pre.withColumn("period", period("year", buckets)).filter(F.col("period").isNotNull())
    return means(tagged, ["period"], exact).orderBy("period")


def city_means(pre: DataFrame, min_records: int = MIN_CITY_RECORDS, exact: bool = False) -> DataFrame:
    """For ``analysis.hottest`` and ``analysis.coldest``."""
    return means(pre, ["city", "country"], exact).filter(F.col("num_records") > min_records)


def yearly_means(pre: DataFrame, exact: bool = False, source: str = "batch", with_grain: bool = False) -> DataFrame:
    """The batch job's mean per (City, Country, year)."""
    found = merge(pre, ["city", "country", "year"])
    columns = [F.col("city").alias("City"), F.col("country").alias("Country"), "year", mean_of("temperature", exact).alias("temperature_moyenne")]
    if with_grain:
        columns.append(F.col("n_rows").alias("n"))
    return found.select(*columns, F.lit(source).alias("source"))


def global_stats(pre: DataFrame, exact: bool = False, value: str = "temperature") -> DataFrame:
    """One row; the extreme count is that of the bounds ``pre`` was built with."""
    return merge(pre, []).select(
        mean_of(value, exact).alias("global_mean_temperature"),
        F.col(f"{value}_min").alias("global_min_temperature"),
        F.col(f"{value}_max").alias("global_max_temperature"),
        F.coalesce("n_extreme", F.lit(0)).alias("extreme_observations"),
    )


def apply_increment(spark: SparkSession, root: str, increment: DataFrame, name: str, keys=KEYS) -> bool:
    """Merge the pre-aggregate of further rows into the versioned one at ``root``.
    ``name`` identifies the increment: one that was applied is not applied again
    (a rerun, or a retry after a failure). Returns whether it was applied."""
    before = versions.current(spark, root)
    applied = before.notes["applied"] if before else []
    if name in applied:
        return False
    pre = increment if before is None else merge(spark.read.parquet(before.path).unionByName(increment), keys)
    versions.publish(pre, root, {"applied": [*applied, name]}, after=before)
    return True
