"""Total order over a table, with positions.

A table is split into ranges of its keys and sorted within each. A row's place
in its range, plus the number of rows in the ranges before, is its position in
the whole: prefix counts over one row per range, never a sort in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE_BITS = 33  # monotonically_increasing_id keeps a partition's row number in the low bits


def write_ordered(df: DataFrame, path: str, keys: list[str], ranges: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` in the order of ``keys`` (ascending, nulls first): each file
    is sorted and the files' ranges follow one another. Two more columns fix the
    order: ``_range`` and ``_place`` in it."""
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    row = F.monotonically_increasing_id()
    placed = dealt.sortWithinPartitions(*keys).withColumns({
        "_range": F.shiftright(row, _PLACE_BITS).cast("int"),
        "_place": row.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
    })
    placed.write.mode(mode).parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The table of ``write_ordered`` with each row's position, from 1."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(starts, "_range").withColumn(position, F.col("_before") + F.col("_place") + 1)
    return placed.drop("_range", "_place", "_before")
