"""City dimension of the stream producer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The five monitored cities (city, country, latitude, longitude).
CITIES = [
    ("Paris", "France", 48.8566, 2.3522),
    ("London", "UK", 51.5074, -0.1278),
    ("New York", "USA", 40.7128, -74.0060),
    ("Tokyo", "Japan", 35.6762, 139.6503),
    ("Sydney", "Australia", -33.8688, 151.2093),
]


def cities(spark: SparkSession) -> DataFrame:
    """The 5-row city dimension (small and fixed: safe to broadcast)."""
    return spark.createDataFrame(CITIES, "city string, country string, lat double, lon double")
