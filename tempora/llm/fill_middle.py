"""Fill-in-the-middle: texts cut into prefix, middle and suffix by one regular expression match.

A text is a sequence of units (a word with the white space before it, or the
white space at the end). ``regexp_count`` gives their number n, the hash of the
document's id two cuts a <= b between units, and a pattern made for the row,
``(unit{a})(unit{b-a})(rest)`` with possessive counted quantifiers, captures
the three parts in one match. Possessive quantifiers keep no way back, so a
match takes one pass and constant stack over texts of any length. The same
match writes the parts in the order of the form:

- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
- ``plain``: the text as it is

``restore`` turns an output and its form back into the text. All of it is
Spark SQL; a row needs nothing but itself, so there is no shuffle.

Defined results: a null text counts as empty; an empty text, and one that holds
a marker, is plain. A null id counts as an empty one in the hash. Rows that
repeat get the same cuts. An empty table gives an empty result. Further columns
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import text_of

SEED = "42"
SHARE = 50  # of 100 documents so many are turned
SPM = 80  # of 100 turned documents so many are in the order suffix, prefix, middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: White space of a unit, and the unit (with possessive parts, which match the same).
SPACE = r"\x20\x09-\x0D"
UNIT = rf"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++"

_PARTS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
_BACK = {
    "psm": (rf"\A{PREFIX}((?s:.*?)){SUFFIX}((?s:.*?)){MIDDLE}((?s:.*+))\z", "$1$3$2"),
    "spm": (rf"\A{SUFFIX}((?s:.*?)){PREFIX}((?s:.*?)){MIDDLE}((?s:.*+))\z", "$2$3$1"),
}
_MIDDLE = {"psm": "$3", "spm": "$3"}
_FIRST = {"psm": "$1", "spm": "$2"}


def numbers(doc_id: Column, seed: str = SEED) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cuts(docs: DataFrame, seed: str = SEED, share: int = SHARE, spm: int = SPM) -> DataFrame:
    """doc_id, text, n (units), form, a and b (the cuts, null if plain)."""
    h1, h2, h3, h4 = numbers(F.col("doc_id"), seed)
    text = text_of()
    rows = docs.select("doc_id", text.alias("text"), F.regexp_count(text, F.lit(UNIT)).cast("long").alias("n"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (h3 % 100 >= share)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm"))
    first, second = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    turned = F.col("form") != "plain"
    return rows.withColumns({"a": F.when(turned, F.least(first, second)), "b": F.when(turned, F.greatest(first, second))})


def transform(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text, n, form, a, b, output: the text in its form."""
    rows = cuts(docs, **options)
    counted = [F.lit(rf"\A((?:{UNIT}){{"), F.col("a"), F.lit(rf"}}+)((?:{UNIT}){{"), F.col("b") - F.col("a"), F.lit(r"}+)((?s:.*+))\z")]
    pattern = F.concat(*counted)
    parts = F.when(F.col("form") == "psm", _PARTS["psm"]).otherwise(_PARTS["spm"])
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, parts))
    return rows.withColumn("output", output)


def _from_output(output: Column, form: Column, to: dict[str, str]) -> Column:
    found = F.when(form == "psm", F.regexp_replace(output, F.lit(_BACK["psm"][0]), F.lit(to["psm"])))
    return found.when(form == "spm", F.regexp_replace(output, F.lit(_BACK["spm"][0]), F.lit(to["spm"])))


def restore(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone. The text of a turned
    document holds no marker, and none can arise where parts meet, so the first
    marker of each kind is the one that was written."""
    return F.when(form == "plain", output).otherwise(_from_output(output, form, {k: v[1] for k, v in _BACK.items()}))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    rows = transform(docs, **options)
    output, form = F.col("output"), F.col("form")

    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    return rows.select(
        "doc_id",
        "n",
        "form",
        F.char_length(_from_output(output, form, _FIRST)).cast("long").alias("prefix_chars"),
        F.char_length(_from_output(output, form, _MIDDLE)).cast("long").alias("middle_chars"),
        sha(output).alias("output_sha256"),
        sha(restore(output, form)).alias("restored_sha256"),
    )


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM {documents}),
units AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM docs),
counted AS (SELECT *, CAST(len(u) AS BIGINT) AS n FROM units),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM counted),
parts AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m,
  array_to_string(list_slice(u, b + 1, n), '') AS s FROM formed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
