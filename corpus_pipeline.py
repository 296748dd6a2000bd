"""The corpus pipeline: documents to packed training sequences.

Each stage works on all that the one before has kept and is written as Parquet
in between. All but the last return the columns of ``documents``.

Defined results: null and empty texts, and texts without a letter, go in the
first stage; so do all where no row has a language to learn from. Of equal
texts with equal doc_ids one row stays, and so with near-duplicates; a null
doc_id is smaller than any other. A null source is a source of its own. An
empty table gives an empty result at every stage. Further columns are kept up
to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm import exact_dedup, language_id, mixing, packing, simhash
from tempora.llm.common import cut, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned: ``MIN_SCORE`` of the words speak for the predicted one."""
    return language_id.known_language(docs, min_score=language_id.MIN_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target share of their source, in random order."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near), ("mix_sources", mix), ("pattern_packing", pack)]

#: Language, fingerprints and tokens can't be had in SQL; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
