"""Explicit schemas of the data the library reads and writes.

An explicit schema avoids the extra pass that CSV schema inference costs and
pins types that the reference got from inference.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Historical CSV as landed: every field as text, parsed later with try_* functions
# so that one bad value never fails the job.
HISTORY_RAW = T.StructType(
    [
        T.StructField("dt", T.StringType(), True),
        T.StructField("AverageTemperature", T.StringType(), True),
        T.StructField("AverageTemperatureUncertainty", T.StringType(), True),
        T.StructField("City", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
        T.StructField("Latitude", T.StringType(), True),
        T.StructField("Longitude", T.StringType(), True),
    ]
)

# The 9-column clean table.
CLEAN_COLUMNS = [
    "date",
    "year",
    "month",
    "temperature",
    "uncertainty",
    "city",
    "country",
    "latitude",
    "longitude",
]

# Stream record: 11 nullable fields, in CSV header order.
RECORD = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lon", T.DoubleType(), True),
        T.StructField("temperature_celsius", T.DoubleType(), True),
        T.StructField("wind_speed_kmh", T.DoubleType(), True),
        T.StructField("wind_direction_deg", T.IntegerType(), True),
        T.StructField("humidity_percent", T.DoubleType(), True),
        T.StructField("pressure_hpa", T.DoubleType(), True),
        T.StructField("source", T.StringType(), True),
    ]
)
RECORD_COLUMNS = [f.name for f in RECORD.fields]

# Unified batch + streaming table.
UNIFIED = T.StructType(
    [
        T.StructField("City", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("temperature_moyenne", T.DoubleType(), True),
        T.StructField("source", T.StringType(), True),
    ]
)
UNIFIED_COLUMNS = [f.name for f in UNIFIED.fields]

# Vendor payloads.
POINT_PAYLOAD = T.StructType(
    [
        T.StructField("temp-surface", T.ArrayType(T.DoubleType()), True),
        T.StructField("wind_u-surface", T.ArrayType(T.DoubleType()), True),
        T.StructField("wind_v-surface", T.ArrayType(T.DoubleType()), True),
        T.StructField("rh-surface", T.ArrayType(T.DoubleType()), True),
        T.StructField("pressure-surface", T.ArrayType(T.DoubleType()), True),
        T.StructField("precip-surface", T.ArrayType(T.DoubleType()), True),
    ]
)

CURRENT_PAYLOAD = T.StructType(
    [
        T.StructField(
            "current",
            T.StructType(
                [
                    T.StructField("temperature_2m", T.DoubleType(), True),
                    T.StructField("relative_humidity_2m", T.DoubleType(), True),
                    T.StructField("pressure_msl", T.DoubleType(), True),
                    T.StructField("wind_speed_10m", T.DoubleType(), True),
                    T.StructField("wind_direction_10m", T.DoubleType(), True),
                ]
            ),
            True,
        )
    ]
)

MAIN_PAYLOAD = T.StructType(
    [
        T.StructField(
            "main",
            T.StructType(
                [
                    T.StructField("temp", T.DoubleType(), True),
                    T.StructField("humidity", T.DoubleType(), True),
                    T.StructField("pressure", T.DoubleType(), True),
                ]
            ),
            True,
        ),
        T.StructField(
            "wind",
            T.StructType(
                [
                    T.StructField("speed", T.DoubleType(), True),
                    T.StructField("deg", T.DoubleType(), True),
                ]
            ),
            True,
        ),
    ]
)

# Kafka source rows (what `format("kafka")` yields).
KAFKA_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)
