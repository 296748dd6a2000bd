"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import cut


def _larger_first(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _state(links: DataFrame):
    """Number and hash sum of the links: equal when a round has changed nothing."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the root is the smallest
    node of its component.

    Each round links all larger neighbours of a node to its smallest neighbour,
    then all smaller ones. The number of rounds grows with the logarithm of the
    number of nodes. A round is two minima per node, combined before they are
    shuffled, and joins against them; no group is ever gathered. Each round is
    written to the shared folder. An empty table gives no components."""
    links = cut(_larger_first(links), "links")
    seen = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = cut(_larger_first(small.unionByName(least.select("a", F.col("m").alias("b")))), "links")
        now = _state(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
