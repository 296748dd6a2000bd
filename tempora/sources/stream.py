"""Streaming sources: CSV landing directory, Kafka, and JSON payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.schemas import RECORD


def read_record_csv_stream(spark: SparkSession, directory: str, schema=RECORD, max_files_per_trigger: int | None = 1,
                           enforce_schema: bool = False) -> DataFrame:
    """Stream of CSV files with a header, fixed schema, bounded files per trigger."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", enforce_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(directory)


def read_parquet_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                        max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream of Parquet files (e.g. a landing directory or a driver table file)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    return reader.parquet(directory)


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest", **extra) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` (servers are a parameter, not a constant)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
               schema=RECORD, **extra) -> DataFrame:
    """Kafka topic of JSON records → typed record columns.

    Needs the Kafka connector for this Spark version on the classpath."""
    raw = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, starting_offsets, **extra)).load()
    return decode_json(raw, schema)


def decode_json(df: DataFrame, schema=RECORD, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """Binary/string JSON column → struct → top-level columns (``data.*``).

    PERMISSIVE: garbage gives all-null fields, one bad field nulls that field."""
    parsed = F.from_json(F.col(value).cast("string"), schema).alias("data")
    return df.select(*keep, parsed).select(*keep, "data.*")


def with_json_rejects(decoded: DataFrame, columns: list[str], name: str = "json_rejects") -> DataFrame:
    """Observe how many decoded rows came out entirely null (garbage or empty
    objects): ``observedMetrics[name]`` in stream progress."""
    all_null = None
    for c in columns:
        cond = F.col(c).isNull()
        all_null = cond if all_null is None else all_null & cond
    return decoded.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(all_null).alias("all_null"))
