"""Exact deduplication by a heavy-hitter split.

1. Every text becomes its SHA-256 digest. The narrow table (doc_id, digest)
   is written once; the texts are not read again for the grouping.
2. A Misra-Gries summary of the digests, kept by each task and merged in two
   levels, names at most ``winners`` frequent digests (``common.frequent``).
3. The named digests are counted exactly. Those that really hold more than
   ``share`` of the rows, at most ``winners`` rows, are broadcast. Their copies
   are dealt with where they are read and are never shuffled.
4. The remaining digests take an ordinary shuffle. No group there exceeds the
   share plus the summary's error, so no task gets a hot group.

The result never depends on what the summary finds; it only decides which way
a digest takes.

Defined results: a null text counts as empty. Null doc_ids rank below all
others. Of repeated rows (same doc_id and text) exactly one stays. An empty
table gives an empty result. Further columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import cut, frequent, text_of, unfold, with_row

def _digest() -> Column:
    return F.unhex(F.sha2(text_of().cast("binary"), 256))


def heavy_digests(keyed: DataFrame, winners: int = 1000, tracked: int = 8192, share: float = 1 / 1024) -> DataFrame:
    """(digest, heavy_keep, heavy_size) of the digests in ``keyed`` (doc_id,
    digest) that hold more than ``share`` of its rows; at most ``winners`` rows."""
    named = frequent(keyed.select(F.hex("digest").alias("item")), "item", winners, tracked).select(
        F.unhex("item").alias("digest"), F.greatest(F.lit(2), F.ceil(F.col("n") * share)).alias("least")
    )
    exact = (
        keyed.join(F.broadcast(named), "digest")  # at most `winners` rows
        .groupBy("digest")
        .agg(F.max("doc_id").alias("heavy_keep"), F.count(F.lit(1)).alias("heavy_size"), F.first("least").alias("least"))
    )
    return cut(exact.where("heavy_size >= least").drop("least"), "heavy")


def _split(rows: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the heavy columns, as (copies of a winner, all others).
    The winner's own row goes with the others: ties on its doc_id are settled there."""
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    copy = F.col("heavy_keep").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("heavy_keep")))
    return marked.where(copy), marked.where(~copy)


def exact_groups(docs: DataFrame, **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (the largest doc_id of equal
    texts), group_size, kept, text_sha256."""
    keyed = cut(docs.select("doc_id", _digest().alias("digest")), "digests")
    copies, others = _split(keyed, heavy_digests(keyed, **limits))
    group = Window.partitionBy("digest")
    newest = group.orderBy(F.col("doc_id").desc_nulls_last())
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    settled = others.select(
        "doc_id",
        F.coalesce("heavy_keep", F.max("doc_id").over(group)).alias("keep_id"),
        F.coalesce("heavy_size", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(newest) == 1).alias("kept"),
        sha,
    )
    return copies.select("doc_id", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"), F.lit(False).alias("kept"), sha).unionByName(settled)


def drop_copies(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keyed = cut(docs.select("doc_id", _digest().alias("digest")), "digests")
    rows = with_row(docs, doc_id=F.col("doc_id"), digest=_digest())
    _, others = _split(rows, heavy_digests(keyed, **limits))
    newest = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    return unfold(others.withColumn("place", F.row_number().over(newest)).where("place = 1"), docs)


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY sha) AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER (PARTITION BY sha ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM {documents})
"""
