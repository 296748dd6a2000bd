"""Reports over the unified batch + streaming table (``City, Country, year,
temperature_moyenne, source``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.means import mean

RECENT_SINCE = 2010
RECENT_TOP = 5


def select_source(unified: DataFrame, source: str) -> DataFrame:
    """Per-source view (``batch`` or ``streaming``)."""
    return unified.filter(F.col("source") == source)


def source_stats(unified: DataFrame) -> DataFrame:
    """Rows, first and last year per source."""
    return unified.groupBy("source").agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        F.min("year").alias("annee_min"),
        F.max("year").alias("annee_max"),
    )


def distinct_counts(unified: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct cities and countries in one job (one Expand, not two scans)."""
    if approx:
        return unified.agg(
            F.approx_count_distinct("City", rsd).alias("nb_villes"),
            F.approx_count_distinct("Country", rsd).alias("nb_pays"),
        )
    return unified.agg(
        F.count_distinct("City").alias("nb_villes"),
        F.count_distinct("Country").alias("nb_pays"),
    )


def distinct_values(unified: DataFrame, column: str = "source") -> DataFrame:
    return unified.select(column).distinct()


def recent_top(unified: DataFrame, since: int = RECENT_SINCE, k: int = RECENT_TOP,
               decimals: int | None = None, exact: bool = False) -> DataFrame:
    """Top ``k`` (City, Country) by the mean of ``temperature_moyenne`` over
    ``year >= since``. Unweighted mean of means, as in the reference; the
    year filter prunes partitions of a year-partitioned table."""
    means = (
        unified.filter(F.col("year") >= since)
        .groupBy("City", "Country")
        .agg(mean("temperature_moyenne", decimals=decimals, exact=exact).alias("temp_moy"))
    )
    return means.orderBy(F.desc("temp_moy"), F.asc("City"), F.asc("Country")).limit(k)


def source_compare(unified: DataFrame, decimals: int | None = None, exact: bool = False) -> DataFrame:
    """Rows and overall mean per source, only when more than one source exists.

    The gate is a count over the per-source result (a handful of rows), not a
    ``collect`` to the driver."""
    per_source = unified.groupBy("source").agg(
        F.count(F.lit(1)).alias("nb_enregistrements"),
        mean("temperature_moyenne", decimals=decimals, exact=exact).alias("temp_moyenne_globale"),
    )
    n_sources = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    return per_source.withColumn("_n", n_sources).filter(F.col("_n") > 1).drop("_n")


def weighted_mean_by(unified: DataFrame, keys: list[str], weight: str = "n") -> DataFrame:
    """Mean weighted by the number of underlying measurements (needs ``n``)."""
    return unified.groupBy(*keys).agg(
        (F.sum(F.col("temperature_moyenne") * F.col(weight)) / F.sum(weight)).alias("temp_moy_ponderee")
    )
