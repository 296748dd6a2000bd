"""Historical CSV source (one file or a directory of CSV files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.schemas import HISTORY_RAW


def read_history_csv(spark: SparkSession, path: str, schema=HISTORY_RAW, enforce_schema: bool = False) -> DataFrame:
    """Header CSV read with an explicit (all-text) schema: no inference pass.

    ``enforceSchema=false`` checks the header against the schema by name, so a
    file with reordered columns fails instead of loading shifted values."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", enforce_schema)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
