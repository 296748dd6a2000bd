"""Batch and streaming sources."""

from tempora.sources.cities import cities
from tempora.sources.history import read_history_csv
from tempora.sources.stream import (
    decode_json,
    kafka_options,
    read_kafka,
    read_parquet_stream,
    read_record_csv_stream,
)
from tempora.sources.unified import read_unified

__all__ = [
    "cities",
    "decode_json",
    "kafka_options",
    "read_history_csv",
    "read_kafka",
    "read_parquet_stream",
    "read_record_csv_stream",
    "read_unified",
]
