"""Batch sinks: Parquet/CSV/JSON files, Kafka, run report."""
