"""Landing of records in event-time order.

A file stream takes files in the order of their times. So that no row comes
behind the watermark that earlier files have set, the files of a landing must
follow one another in event time. One aggregate over the time column keeps a
quantile sketch, its quantiles are the borders of the files (as many as the
number of rows needs), and one shuffle writes each range as a file of its own
to a staging folder. ``publish`` then moves staged files into the landing
folder in order, each with a later time than the one before.

Rows that share one event time may be many: where several borders are equal,
the rows at that time are dealt out over the files between them. Rows without
an event time go with the first file.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.parsing import parse_timestamp
from tempora.schemas import RECORD

ROWS_PER_FILE = 1_000_000
SKETCH = 4096  # rank error about 0.1 %: enough for some hundreds of even files
_FILE = "_file"


def borders(df: DataFrame, by: Column, rows_per_file: int = ROWS_PER_FILE, least: int = 1, k: int = SKETCH) -> list[int]:
    """Ascending borders that split the rows into files of some ``rows_per_file``
    rows, ``least`` files at least, as microseconds. One pass over ``by``, a
    timestamp; only the sketch (about 100 KB) comes to the driver."""
    n, sketch = df.agg(F.count(by), F.kll_sketch_agg_bigint(F.unix_micros(by), F.lit(k))).first()
    files = max(least, math.ceil(n / rows_per_file))
    if n == 0 or files == 1:
        return []
    ranks = F.array(*[F.lit(i / files) for i in range(1, files)])
    one = df.sparkSession.createDataFrame([(sketch,)], "sketch binary")
    return sorted(one.select(F.kll_sketch_get_quantile_bigint("sketch", ranks)).first()[0])


def _count_below(value: Column, sorted_borders: list[int], or_equal: bool) -> Column:
    """How many borders are below ``value`` (or equal to it): a search tree of
    comparisons, so a row takes as many as the logarithm of the number of borders."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        border = F.lit(sorted_borders[mid])
        right = value >= border if or_equal else value > border
        return F.when(right, tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(sorted_borders))


def file_number(value: Column, sorted_borders: list[int], salt: Column) -> Column:
    """The number of the range that ``value`` (microseconds) lies in; a value on
    equal borders is dealt out over the ranges they part. Null goes with the first."""
    first, last = _count_below(value, sorted_borders, False), _count_below(value, sorted_borders, True)
    return F.when(value.isNull(), F.lit(0)).otherwise(first + F.pmod(salt, last - first + 1)).cast("int")


def stage_in_order(records: DataFrame, staging: str, rows_per_file: int = ROWS_PER_FILE, least: int = 1, by: str = "timestamp",
                   as_parquet: bool = False) -> list[str]:
    """Write ``records`` as files that follow one another in event time: header
    CSV files with the columns of ``RECORD``, or Parquet files with all columns.
    Returns the staged folders in that order, one for each file. Nothing is in
    a landing folder yet."""
    spark = records.sparkSession
    when = parse_timestamp(by, records.schema[by].dataType)
    found = borders(records.select(when.alias("when")), F.col("when"), rows_per_file, least)
    salt = F.monotonically_increasing_id()  # the same for a task that runs again: it reads the same files
    number = file_number(F.unix_micros(when), found, salt)
    columns = [F.col(f"`{c}`") for c in records.columns] if as_parquet else [F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD.fields]
    writer = records.select(*columns, number.alias(_FILE)).repartition(len(found) + 1, _FILE).write.partitionBy(_FILE)
    if as_parquet:
        writer.parquet(staging)
    else:
        writer.option("header", True).csv(staging)
    fs, path = _file_system(spark, staging)
    folders = [s.getPath().getName() for s in fs.listStatus(path(staging)) if s.isDirectory()]
    return [f"{staging}/{name}" for name in sorted(folders, key=lambda x: int(x.partition("=")[2]))]


def publish(spark: SparkSession, staged: list[str], landing: str) -> None:
    """Move the files of the staged folders into ``landing``, in order. Each file
    appears at once (a rename) and is newer than all that are there. On a store
    without settable times the order is that of the moves."""
    fs, path = _file_system(spark, landing)
    fs.mkdirs(path(landing))
    there = [s.getModificationTime() for s in fs.listStatus(path(landing)) if s.isFile()]
    clock = max([math.ceil(time.time() * 1000), *(t + 1 for t in there)])
    for folder in staged:
        number = folder.rpartition("=")[2]
        for status in sorted(fs.listStatus(path(folder)), key=lambda s: s.getPath().getName()):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            target = path(f"{landing}/{int(number):07d}-{name}")
            fs.setTimes(status.getPath(), clock, -1)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"{status.getPath()} could not be moved to {target}")
            clock += 1


def land_in_order(records: DataFrame, landing: str, staging: str, **sizes) -> int:
    """Stage and publish; returns the number of files."""
    staged = stage_in_order(records, staging, **sizes)
    publish(records.sparkSession, staged, landing)
    return len(staged)


def _file_system(spark: SparkSession, where: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    return path(where).getFileSystem(sc._jsc.hadoopConfiguration()), path
