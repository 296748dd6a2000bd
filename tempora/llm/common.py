"""Helpers shared by the operators of this folder.

Operators take the columns they name and nothing else, so that a table may
carry further columns of any name. Where an operator returns whole input rows,
the row travels as one struct (``ROW``) and is unfolded at the end: no column
of the input can clash with one of ours.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.session import scratch_path

ROW = "_row"


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col), F.lit(""))


def with_row(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as one struct, next to the named columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *[c.alias(k) for k, c in columns.items()])


def unfold(df: DataFrame, like: DataFrame) -> DataFrame:
    """Back to the columns of ``like``."""
    return df.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in like.columns])


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, no executor's loss brings back earlier work, and later joins know
    the table's size."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(df: DataFrame) -> DataFrame:
    """``df``; from now on Python workers find this package where the driver has
    it, whatever folder the session was started in. On a cluster whose machines
    don't share that path, pass the package with ``--py-files`` as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
    return df


def smallest_hashes(rows: DataFrame, label: str, k: int) -> DataFrame:
    """For each value of ``label`` the ``k`` rows of ``rows`` (doc_id and others,
    distinct) with the smallest hash of their doc_id: a sample that is the same
    on every run. Only rows below a hash that some four times k of a label's
    rows can be expected to lie under are ranked, so the ranking's tasks do not
    grow with the input. The labels themselves must be few: their counts are
    brought to the driver."""
    u = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1)
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return rows
    bound = None
    for r in counts:
        limit = F.lit(min((1 << 63) - 1, (1 << 63) * 4 * k // r["n"]))
        bound = F.when(F.col(label) == F.lit(r[label]), limit) if bound is None else bound.when(F.col(label) == F.lit(r[label]), limit)
    rank = Window.partitionBy(label).orderBy("_hash", "doc_id")
    few = rows.withColumn("_hash", u).where(F.col("_hash") <= bound)
    return few.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k).drop("_hash", "_rank")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BLOCKS = 64  # first-level merges of a frequency summary


def frequent(values: DataFrame, column: str, winners: int = 1000, tracked: int = 8192) -> DataFrame:
    """(item, estimate, n): at most ``winners`` frequent values of a column and
    the number n of rows, from a Misra-Gries summary.

    Spark's ``approx_top_k`` functions keep such a summary in each task: a
    fixed number of counters, lowered together when they run out, with an error
    that falls with their number. Two levels keep what one task merges bounded.
    The merge has a grouping key (always 0) because it cannot merge nothing, as
    an aggregation without one would in tasks that have no rows."""
    parts = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(BLOCKS)).alias("block")).agg(
        F.expr(f"approx_top_k_accumulate({column}, {tracked})").alias("summary"), F.count(F.lit(1)).alias("n")
    )
    merged = parts.groupBy(F.pmod("block", F.lit(1))).agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"), F.sum("n").alias("n"))
    top = merged.select("n", F.explode(F.expr(f"approx_top_k_estimate(summary, {winners})")).alias("top"))
    return top.select(F.col("top.item").alias("item"), F.col("top.count").alias("estimate"), "n")
