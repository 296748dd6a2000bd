"""File sinks. Spark's writers commit atomically (task files are renamed into
place on job commit), so a reader never sees half a file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.schemas import RECORD, UNIFIED


def write_partitioned(df: DataFrame, path: str, partition_col: str = "year", mode: str = "overwrite",
                      max_records_per_file: int | None = None) -> None:
    """Partitioned Parquet write with few files per partition.

    ``REBALANCE(partition_col)`` shuffles rows of one partition value together
    (one file per value instead of one per task and value), and AQE splits a
    value that is too large into several tasks, so one dominant year is never
    a single straggler."""
    writer = df.hint("rebalance", partition_col).write.mode(mode).partitionBy(partition_col)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_clean(clean: DataFrame, path: str, **kwargs) -> None:
    """Clean table → Parquet partitioned by year, overwrite."""
    write_partitioned(clean, path, "year", "overwrite", **kwargs)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_yearly(yearly: DataFrame, path: str, rerun_years_only: bool = False) -> None:
    """Batch yearly means → their own root, partitioned by year.

    A full run overwrites the root (a rerun never duplicates rows). With
    ``rerun_years_only`` only the years present in ``yearly`` are replaced
    (dynamic partition overwrite). Within its year a file is in the total order
    (Country, City, year); ``ordered`` gives that order over a whole table."""
    out = as_unified(yearly).hint("rebalance", "year").sortWithinPartitions("year", "Country", "City")
    writer = out.write.mode("overwrite").partitionBy("year")
    if rerun_years_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


GRAIN_COLUMNS = ["window_start", "n"]


def as_unified(df: DataFrame) -> DataFrame:
    """Project and cast to the unified table's 5 typed columns, keeping the
    optional grain columns (``window_start``, ``n``) when present."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in UNIFIED.fields]
    return df.select(*cols, *[c for c in GRAIN_COLUMNS if c in df.columns])


def ordered(yearly: DataFrame) -> DataFrame:
    """Total order (Country, City, year): range partitioning + local sort."""
    keys = ["Country", "City", "year"]
    return yearly.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_single_csv(summary: DataFrame, path: str) -> None:
    """Bounded summary → one CSV file with a header. Never for detail data."""
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_single_json(summary: DataFrame, path: str) -> None:
    """Bounded summary → one JSON-lines file. Never for detail data."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_history_csv(raw: DataFrame, directory: str) -> None:
    """Historical rows → header CSV files, every field as text (the landing
    format the historical source reads)."""
    raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).write.mode("overwrite").option(
        "header", True
    ).csv(directory)


def land_records_csv(records: DataFrame, directory: str) -> None:
    """Records → new CSV files (header, 11 columns) in a stream landing directory.

    Columns are cast to the record schema first, so the timestamp is landed as
    full-precision text."""
    records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD.fields]).write.mode("append").option("header", True).csv(directory)


def show(df: DataFrame, n: int = 20) -> None:
    """Display helper: first ``n`` rows, untruncated."""
    df.show(n, truncate=False)
