"""The pipeline against plain Python, and the wiring of the registered queries."""

import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tempora.llm import language_id, mixing

from .test_dedup import plain_components
from .test_rest import tokens

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_python(spark):
    docs = duckdb.sql(f"select doc_id, text, source from '{SF}/documents.parquet'").fetchall()
    lang = {r["doc_id"]: r for r in language_id.identify(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    docs = [r for r in docs if lang[r[0]]["lang_pred"] != "und" and lang[r[0]]["score"] >= 0.4]
    newest = {}
    for r in docs:
        newest[r[1]] = max(r, newest.get(r[1], r))
    docs = sorted(newest.values())
    stay = {c for _, _, c in plain_components([r[:2] for r in docs], 4)}
    docs = [r for r in docs if r[0] in stay]
    con = duckdb.connect()
    con.execute("create table kept (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into kept values (?, ?, ?)", docs)
    copies = Counter(r[0] for r in con.execute(f"select doc_id from ({mixing.ORACLE.format(documents='kept')})").fetchall())
    want = Counter()
    for doc_id, text, _ in docs:
        for piece, at in enumerate(range(0, n := len(tokens(text)), 2048)):
            want[doc_id, piece, at, min(2048, n - at)] += copies[doc_id]
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in out) == +want
    filled = defaultdict(int)
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled[r["sequence_id"]] == r["offset"]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


ODD = [
    (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "same words here and there", None, None, 1), (2, "same words here and there", None, None, 1),
    (3, "same words here and there", "en", "t", 1), (None, "more of the words in a text", "en", "s", 2), (4, "12 34", "de", "t", 3), (5, "un mot et " * 4000, "fr", "s", 4),
]


def test_stages_on_odd_rows(spark):
    """Nulls, repeated rows, ties and clashing further columns: every stage runs on what the one before kept."""
    like = spark.read.parquet(f"{SF}/documents.parquet")
    docs = spark.createDataFrame(ODD, like.schema).withColumn("p", F.lit("x"))
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), name)
        assert docs.columns == [*like.columns, "p"]
        sizes.append(docs.count())
    assert sizes[0] == 5 and sizes[1] <= 3 and sizes[2] == sizes[1]
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} <= {None, 3, 5}


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registered_queries():
    names = set(__spark_entry__.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
