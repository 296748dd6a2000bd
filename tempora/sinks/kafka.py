"""Kafka sink: records as JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_kafka_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows → ``(key, value)`` with the whole row as a JSON value."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, key: str | None = None) -> None:
    """Batch write to a topic, acknowledged by all in-sync replicas.

    Needs the Kafka connector for this Spark version on the classpath."""
    (
        to_kafka_rows(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .save()
    )
