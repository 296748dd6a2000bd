"""Fill-in-the-middle against plain Python and DuckDB."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from tempora.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "  \t\n", "a", " a", "a ", "one two  three\tfour\nfive ", "has <P> in it", "<S>", "x<M>", "almost < P> <S <M",
    "ends with <", "<", "é 𝒳 🙂🙂 日本 語 nbsp em \x1f y " * 5, r"a$1 \1 \\ $ {2} (x) [y] " * 9, "wort  " * 300_000, " " * 400_000, "x" * 500_000,
]


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
    output = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sizes = (None, None) if form == "plain" else (len(p), len(m))
    return doc_id, n, form, *sizes, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    out = [(31 * j + i, t, 1, "x") for j in range(6) for i, t in enumerate(TEXTS)]
    return out + [(None, "a b c d", 1, "x"), (None, None, 1, "x"), *out[:3], *out[:3], (-5, "one two three", 1, None)]


def test_report_equals_plain_python(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, form string").repartition(4)
    found = fill_middle.report(df).collect()
    assert Counter(map(tuple, found)) == Counter(plain(i, t) for i, t, *_ in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.report(df.limit(0)).count() == 0


def test_outputs_and_restoring(spark, rows):
    df = fill_middle.transform(spark.createDataFrame(rows, "doc_id long, text string, n int, form string"))
    wrong = df.where(fill_middle.restore(df["output"], df["form"]) != df["text"])
    assert wrong.count() == 0
    assert df.where("form <> 'plain' and length(output) <> length(text) + 9").count() == 0


def test_shares_are_parameters(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "'a b c' as text")
    forms = {r["form"]: r["count"] for r in fill_middle.report(df).groupBy("form").count().collect()}
    assert 900 < forms["plain"] < 1100 and 700 < forms["spm"] < 900 and 120 < forms["psm"] < 280
    assert fill_middle.report(df, share=0).where("form <> 'plain'").count() == 0
    assert fill_middle.report(df, share=100, spm=0).where("form <> 'psm'").count() == 0


def test_oracle_equals_plain_python(spark):
    """RE2 matches the same units."""
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)]
    con = duckdb.connect()
    con.register("d", spark.createDataFrame(rows, "doc_id long, text string").toArrow())
    assert Counter(con.execute(fill_middle.ORACLE.format(documents="d")).fetchall()) == Counter(plain(*r) for r in rows)


def test_no_shuffle_and_no_python(spark):
    plan = fill_middle.report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
