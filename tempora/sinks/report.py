"""Run report: one row of figures computed in Spark (no Python rounding)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.means import mean
from tempora.operators.analysis import EXTREME_HIGH, EXTREME_LOW, is_extreme
from tempora.operators.clean import half_up_percent, is_valid, parse_history


def run_report(raw: DataFrame, low: float = EXTREME_LOW, high: float = EXTREME_HIGH, exact: bool = False,
               city: str = "City", country: str = "Country", **parse_args) -> DataFrame:
    """One-row report over the raw table in a single scan: rows read, columns,
    rows kept/removed, removal %, global mean/min/max, extreme count."""
    parsed = parse_history(raw, **parse_args)
    ok = is_valid(city, country)
    kept_temp = F.when(ok, F.col("temperature"))
    report = parsed.agg(
        F.count(F.lit(1)).alias("rows_before_cleaning"),
        F.count_if(ok).alias("rows_after_cleaning"),
        mean(kept_temp, exact=exact).alias("global_mean_temperature"),
        F.round(F.min(kept_temp), 2).alias("global_min_temperature"),
        F.round(F.max(kept_temp), 2).alias("global_max_temperature"),
        F.count_if(ok & is_extreme("temperature", low, high)).alias("extreme_observations"),
    )
    return (
        report.withColumn("rows_extracted", F.col("rows_before_cleaning"))
        .withColumn("columns", F.lit(len(raw.columns)))
        .withColumn("rows_removed", F.col("rows_before_cleaning") - F.col("rows_after_cleaning"))
        .withColumn("removal_percentage", half_up_percent("rows_removed", "rows_before_cleaning"))
    )


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report → one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
