"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mix. Its rate is the mean number of
times that one of its documents is repeated to reach the share. Each document
draws its number of copies by inverting the Poisson distribution of that mean
at a uniform number hashed from (seed, doc_id): the same document always draws
the same number, on any cluster and on any retry. Documents are exploded by
their count and shuffled globally by a hash of (seed, doc_id, copy).

The distribution function is tabulated once for each source, up to where it
reaches one in double precision. Rates over ``PART`` are drawn as a sum of
independent Poisson numbers of at most that mean, so no rate is capped.

Defined results: documents without a source form a source of their own (null).
Repeated rows draw the same number, each for itself; a null doc_id is hashed
as the word ``null``. An empty table gives an empty result. The text plays no
part. Further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import cut, unfold, with_row

PART = 32.0  # largest mean that is inverted in one draw
SEED = "mix-1"
UNITS = 1_000_000  # target shares are whole numbers of 1/UNITS, so that their sum is exact


def _hashed(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, smoothing: float = 0.5, total: int | None = None) -> DataFrame:
    """(source, n_docs, rate, draws, cdf) for each source of ``docs``.

    ``weights``: target share by source, in any unit; sources that it doesn't
    name get none. By default a source's share goes with its number of
    documents to the power ``smoothing``. ``total``: documents in the mix, as
    many as there are by default."""
    counts = cut(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs")), "sources")
    if weights is None:
        share = F.pow(F.col("n_docs").cast("double"), F.lit(smoothing)) if smoothing != 0.5 else F.sqrt("n_docs")
    else:
        named = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.lit(None)
        share = F.coalesce(F.element_at(named, F.col("source")).cast("double") if weights else F.lit(0.0), F.lit(0.0))
    units = F.floor(share * UNITS).cast("long")
    sums = counts.agg(F.sum("n_docs").alias("n"), F.sum(units).alias("units")).first()
    size, all_units = float(total if total is not None else sums["n"] or 0), float(sums["units"] or 1)
    rates = counts.select("source", "n_docs", (F.lit(size) * units / F.lit(all_units) / F.col("n_docs")).alias("rate"))
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    mean = F.col("rate") / F.col("draws")
    terms = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    first = F.struct(F.array(F.exp(-F.col("mean"))).alias("cdf"), F.exp(-F.col("mean")).alias("p"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mean") / k
        return F.struct(F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"), p.alias("p"))

    return rates.withColumn("mean", mean).withColumn("cdf", F.aggregate(F.sequence(F.lit(1), terms), first, add)["cdf"]).drop("mean")


def _copies(draws: Column, cdf: Column, doc_id: Column, seed: str) -> Column:
    """Number of copies: for each draw, how many values of the distribution
    function the hashed uniform number reaches."""

    def draw(j: Column) -> Column:
        u = F.conv(F.substring(_hashed(F.lit(seed), _key(doc_id), j.cast("string")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
        return F.size(F.filter(cdf, lambda c: c <= u))

    return F.aggregate(F.sequence(F.lit(1), draws), F.lit(0), lambda acc, j: acc + draw(j))


def replicate(docs: DataFrame, seed: str = SEED, **mix) -> DataFrame:
    """One row per copy, globally shuffled: the input row as a struct, with
    rate, copies (of this document), copy (from 0) and shuffle_key. Each
    partition is a random part of the mix in the order of the key."""
    rates = cut(source_rates(docs, **mix), "rates")  # its size is known: Spark chooses how to join
    rows = with_row(docs, doc_id=F.col("doc_id"), source=F.col("source"))
    drawn = rows.join(rates.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    drawn = drawn.withColumn("copies", _copies(F.col("draws"), F.col("cdf"), F.col("doc_id"), seed)).where("copies > 0")
    copies = drawn.drop("cdf", "of", "draws", "n_docs").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    key = F.conv(F.substring(_hashed(F.lit(seed), F.lit("order"), _key(F.col("doc_id")), F.col("copy").cast("string")), 1, 15), 16, 10).cast("long")
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, rate (6 decimals), copies, copy, shuffle_key of each copy."""
    narrow = docs.select("doc_id", "source")
    return replicate(narrow, **options).select("doc_id", "source", F.round("rate", 6).alias("rate"), "copies", "copy", "shuffle_key")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows, with the columns of ``docs``."""
    return unfold(replicate(docs, **options), docs)


# The default mix: shares by the square root of the number of documents.
ORACLE = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n_docs, CAST(floor(sqrt(count(*)) * {UNITS}) AS BIGINT) AS units FROM {{documents}} GROUP BY source),
sums AS (SELECT CAST(sum(n_docs) AS DOUBLE) AS n, CAST(sum(units) AS DOUBLE) AS units FROM counts),
rates AS (SELECT source, sums.n * counts.units / sums.units / n_docs AS rate FROM counts, sums),
parts AS (SELECT *, greatest(1, CAST(ceil(rate / {PART}) AS INT)) AS draws FROM rates),
terms AS (
  SELECT source, 0 AS k, exp(-rate / draws) AS p, exp(-rate / draws) AS c, rate / draws AS mean FROM parts
  UNION ALL
  SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM terms WHERE k < CAST(ceil(mean + 12 * sqrt(mean) + 24) AS INT)),
docs AS (SELECT row_number() OVER () AS r, doc_id, d.source, rate, draws, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id
         FROM {{documents}} d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source),
drawn AS (SELECT *, CAST('0x' || substr(md5('{SEED}:' || id || ':' || j), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
          FROM (SELECT *, unnest(range(1, draws + 1)) AS j FROM docs)),
counted AS (SELECT r, doc_id, drawn.source, rate, id, CAST(count(c) AS INT) AS copies
            FROM drawn LEFT JOIN terms ON drawn.source IS NOT DISTINCT FROM terms.source AND c <= u GROUP BY ALL)
SELECT doc_id, source, round(rate, 6) AS rate, copies, copy,
       CAST('0x' || substr(md5('{SEED}:order:' || id || ':' || copy), 1, 15) AS BIGINT) AS shuffle_key
FROM (SELECT *, unnest(range(0, copies))::INT AS copy FROM counted WHERE copies > 0)
"""
