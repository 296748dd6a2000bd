"""Substring deduplication by seed and extend.

A window is ``length`` consecutive words of one document. It is removed where
the same words also start earlier: in a document with a smaller doc_id, or
earlier in the same one.

1. Seeds. The seed of a window is the smallest hash among its runs of ``gram``
   words (winnowing): equal windows have equal seeds. Each document names its
   distinct seeds, about one for every seven words.
2. Join. Documents are joined on their seeds: only a seed that occurs at two
   places can lie in a repeat. The few seeds that hold a large share of all
   rows are found first by a bounded frequency summary and sent to the tasks;
   they are never shuffled, so no seed makes a hot task.
3. Extend. A shared seed is extended both ways, to all windows that have it as
   their seed: a run of up to ``length - gram + 1`` windows, named by a 96-bit
   hash of all its words. Of equal runs the earliest stays and all windows of
   the others are matched. What this leaves open are seeds with several
   different runs around them (the edges of repeats): the windows of their
   earliest runs are matched one by one, by a hash of their words. The
   earliest place of a window always lies in such a run: were its run not the
   earliest, the window would stand in an earlier one as well. Runs and windows
   of frequent seeds are first compared within salted parts of the documents,
   so that one passage in very many documents is spread over many tasks.
4. Repeats. Adjacent matched windows are joined to maximal repeats of at least
   ``length`` words, and the words they cover are removed.

A document whose words are all the same as those of an earlier one goes as a
whole; its runs are equal to earlier ones, so it adds nothing to the edges.

Defined results: words are runs of bytes other than 0x20 and 0x09-0x0D, and a
null text has none. A null doc_id counts as the largest number. Rows with the
same doc_id are one document: at equal starts neither is earlier, so repeated
rows don't remove each other. Texts below ``length`` words lose nothing. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tempora.llm.common import cut, frequent, on_workers
from tempora.llm.hashing import range_hashes

LENGTH = 20
GRAM = 8
BLOCK = 100_000  # words of one text that are hashed at once
SALTS = 32
KEY = np.dtype([("k1", "<i8"), ("k2", "<i4")])  # of the words of a window or a run
LAST = (1 << 63) - 1  # stands for a null doc_id


class Words:
    """The words of a text, joined by one space, with their places in bytes."""

    def __init__(self, text: bytes | None):
        words = (text or b"").split()  # bytes: only ASCII white space splits
        self.joined = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(size + 1) - 1
        self.starts = self.ends - size
        self.n = len(words)

    def blocks(self, length: int) -> Iterator[tuple[int, int]]:
        """First and last + 1 word of blocks; each window lies in exactly one."""
        for at in range(0, max(0, self.n - length + 1), BLOCK):
            yield at, min(self.n, at + BLOCK + length - 1)

    def grams(self, first: int, last: int, gram: int) -> np.ndarray:
        """Hashes of all runs of ``gram`` words within words [first, last)."""
        begin = int(self.starts[first])
        raw = np.frombuffer(self.joined, np.uint8)[begin : int(self.ends[last - 1])]
        return range_hashes(raw, self.starts[first : last - gram + 1] - begin, self.ends[first + gram - 1 : last] - begin)

    def key(self, start: int, length: int, salt: int = 0) -> bytes:
        return xxh3_128_digest(self.joined[self.starts[start] : self.ends[start + length - 1]], salt)[: KEY.itemsize]


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over each ``width`` consecutive items, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = best(x[: len(x) - step], x[step:])
        have += step
    return x


def _leftmost_least(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each ``width`` consecutive items, and the first place that has it."""
    at, have = np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        right = h[step:] < h[: len(h) - step]
        h, at = np.where(right, h[step:], h[: len(h) - step]), np.where(right, at[step:], at[: len(at) - step])
        have += step
    return h, at


def seeds_by_window(words: Words, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block its first word; the seed of each window and its place
    (first of equal ones); and the hash of each run of words that is the seed of a window."""
    width = length - gram + 1
    for first, last in words.blocks(length):
        h = words.grams(first, last, gram)
        least, at = _leftmost_least(h, width)
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        yield first, least, at, h[h == _sliding(padded, width, np.maximum)]


def seeds(words: Words, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Distinct seeds of a text; those that it has at several places are named twice."""
    found = [x for *_, x in seeds_by_window(words, length, gram)]
    value, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    # a seed at the edge of two blocks may be counted twice: that costs a look, no more
    return np.concatenate([value, value[n > 1]])


def describe(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc (doc_id, null as LAST), tk (tells texts with one doc_id apart), sha
    (of the joined words), n_words, seeds; one row per row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, tk, n, found = [], [], [], []
            for text in batch.column("text"):
                words = Words(text.as_py())
                sha.append(sha256(words.joined).digest())
                tk.append(_tk(sha[-1]))
                n.append(words.n)
                found.append(seeds(words, length, gram).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(tk, pa.int32()), pa.array(sha, pa.binary()), pa.array(n, pa.int64()), lists], ["doc", "tk", "sha", "n_words", "seeds"])

    return _texts(docs).mapInArrow(each, "doc long, tk int, sha binary, n_words long, seeds array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return on_workers(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("text").cast("binary").alias("text"))


def _shared_seeds(described: DataFrame) -> DataFrame:
    """doc, seeds, hot: per document the seeds it shares (with itself or
    others) and those of them that are frequent."""
    rows = described.select("doc", F.explode("seeds").alias("seed"))
    named = frequent(rows, "seed").where("estimate > greatest(1, n / 20000)")
    hot = cut(named.select(F.col("item").alias("seed"), F.lit(True).alias("hot")), "hot-seeds")
    marked = rows.join(F.broadcast(hot), "seed", "left")  # at most 1,000 rows
    same = Window.partitionBy("seed")
    cold = marked.where("hot is null").withColumn("places", F.count(F.lit(1)).over(same)).where("places > 1").drop("places")
    shared = cold.unionByName(marked.where("hot"))
    return shared.groupBy("doc").agg(F.collect_set("seed").alias("seeds"), F.collect_set(F.when(F.col("hot"), F.col("seed"))).alias("hot"))


PLACE = "k1 long, k2 int, seed long, doc long, tk int, start int, n int, salt int"


def _runs(texts: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each run of windows with one shared seed: key, seed, doc, tk,
    first window, number of windows, salt (-1 unless the seed is frequent)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, marks, hot in zip(*(batch.column(c) for c in ("doc", "text", "seeds", "hot"))):
                words = Words(text.as_py())
                tk, salt = _tk(sha256(words.joined).digest()), doc.as_py() % SALTS
                marks, hot = (x.values.to_numpy().view(np.uint64) for x in (marks, hot))
                for first, least, at, _ in seeds_by_window(words, length, gram):
                    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    n = np.diff(np.r_[begin, len(at)])
                    ok = np.isin(least[begin], marks)
                    begin, n = begin[ok], n[ok]
                    if not len(begin):
                        continue
                    spans = zip((begin + first).tolist(), (n + length - 1).tolist(), (at[begin] - begin).tolist())
                    keys = np.frombuffer(b"".join([words.key(*x) for x in spans]), KEY)
                    seed = least[begin]
                    columns = [keys["k1"].copy(), keys["k2"].copy(), seed.view(np.int64), np.full(len(n), doc.as_py()), np.full(len(n), tk, np.int32)]
                    columns += [(begin + first).astype(np.int32), n.astype(np.int32), np.where(np.isin(seed, hot), salt, -1).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in PLACE.split(", ")])

    return texts.join(shared, "doc").select("doc", "text", "seeds", "hot").mapInArrow(each, PLACE)


def _windows(texts: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The windows of ``runs``, a row each, with the key of its own words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, tk, own in zip(*(batch.column(c) for c in ("doc", "text", "tk", "runs"))):
                words = Words(text.as_py())
                if _tk(sha256(words.joined).digest()) != tk.as_py():
                    continue  # another text with the same doc_id
                start, n, seed, salt = (own.values.field(c).to_numpy() for c in ("start", "n", "seed", "salt"))
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                keys = np.frombuffer(b"".join([words.key(x, length) for x in at.tolist()]), KEY)
                columns = [keys["k1"].copy(), keys["k2"].copy(), np.repeat(seed, n), np.full(len(at), doc.as_py()), np.full(len(at), tk.as_py(), np.int32)]
                columns += [at.astype(np.int32), np.ones(len(at), np.int32), np.repeat(salt, n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in PLACE.split(", ")])

    of_doc = runs.groupBy("doc", "tk").agg(F.collect_list(F.struct("start", "n", "seed", "salt")).alias("runs"))
    return texts.join(of_doc, "doc").select("doc", "text", "tk", "runs").mapInArrow(each, PLACE)


_LATER = "first_doc < doc or (first_doc = doc and first_start < start)"


def _with_first(places: DataFrame) -> DataFrame:
    """``places`` (runs or windows) with the earliest place of the same key, in
    two steps: among the places with one salt, then among the first of each
    salt. Returns the later places of either step, and the earliest ones,
    marked by ``later``.

    All branches of the plan that use the result read one shuffle of
    ``places``. For that its columns must be the same in each, so a condition
    that always holds names all of them above the window; and no condition may
    be one that could be moved below it."""
    names = [x.split()[0] for x in PLACE.split(", ")]
    whole = f"bit_count(xxhash64(first_doc, {', '.join(names)})) >= 0"

    def against(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("doc", "start").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("first_doc", F.first("doc").over(order)).withColumn("first_start", F.first("start").over(order)).where(whole)

    parts = against(places, "k1", "k2", "salt").select(*names, F.expr(_LATER).alias("later"))
    done = parts.where("case when later then true else salt < 0 end")
    tops = against(parts.where("case when later then false else salt >= 0 end").select(*names), "k1", "k2").select(*names, F.expr(_LATER).alias("later"))
    return done.unionByName(tops)


def _matched(texts: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """doc, tk, start, n: every n windows from ``start`` on that also start earlier."""
    runs = _with_first(_runs(texts, shared, length, gram))
    earliest = runs.where("not later").drop("later")
    open_seeds = earliest.groupBy("seed").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("k2").alias("c"), F.max("k2").alias("d"))
    open_seeds = open_seeds.where("a <> b or c <> d").select("seed")
    edges = _with_first(_windows(texts, earliest.join(open_seeds, "seed"), length))
    return runs.where("later").select("doc", "tk", "start", "n").unionByName(edges.where("later").select("doc", "tk", "start", "n"))


def _tk(digest: bytes) -> int:
    return int.from_bytes(digest[:4], "little", signed=True)


def _without(words: Words, starts: np.ndarray, n: np.ndarray, length: int) -> tuple[bytes, int, list[dict]]:
    """What is left of a text without ``n`` windows from each of ``starts`` on,
    the number of words removed, and the text's maximal repeats."""
    edge = np.zeros(words.n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, starts + n + length - 1, 1)
    covered = np.cumsum(edge[:-1]) > 0
    kept = b" ".join([words.joined[a:b] for a, b in zip(words.starts[~covered].tolist(), words.ends[~covered].tolist())])
    matched = np.zeros(words.n + 1, np.int64)
    np.add.at(matched, starts, 1)
    np.subtract.at(matched, starts + n, 1)
    side = np.flatnonzero(np.diff(np.r_[0, np.cumsum(matched) > 0].astype(np.int8)))
    return kept, int(covered.sum()), [{"first": a, "last": b + length - 2} for a, b in zip(side[::2].tolist(), side[1::2].tolist())]


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of
    the kept words, joined by one space), repeats (first and last word of each
    maximal repeat; null where nothing or everything goes) and, if asked for,
    text (the kept words)."""
    if not 0 < gram <= length:
        raise ValueError("a seed has between one and `length` words")
    described = cut(describe(docs, length, gram), "described")
    groups = described.groupBy("sha").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copied = cut(groups.where("first < last").select("sha", "first"), "copied")
    marked = described.join(copied, "sha", "left").withColumn("copy", F.coalesce(F.col("first") < F.col("doc"), F.lit(False)) & (F.col("n_words") >= length))
    shared = _shared_seeds(described)  # copies included: to leave them out, all lists of seeds would be shuffled

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs).repartition(n, "doc")  # shuffled once: both joins read it
    starts = _matched(texts, shared, length, gram).groupBy("doc", "tk").agg(F.collect_set(F.struct("start", "n")).alias("starts"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, tk, found in zip(*(batch.column(c) for c in ("doc", "text", "tk", "starts"))):
                words = Words(text.as_py())
                if _tk(sha256(words.joined).digest()) != tk.as_py():
                    continue
                kept, removed, spans = _without(words, found.values.field("start").to_numpy(), found.values.field("n").to_numpy(), length)
                rows.append((doc.as_py(), tk.as_py(), removed, sha256(kept).digest(), spans, kept if with_text else None))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "tk", "n_removed", "kept", "repeats", "text"])

    partly = texts.join(starts, "doc").mapInArrow(each, "doc long, tk int, n_removed long, kept binary, repeats array<struct<first: long, last: long>>, text binary")
    partly = partly.dropDuplicates(["doc", "tk"])
    whole = marked.select("doc", "tk", "sha", "n_words", "copy").join(partly, ["doc", "tk"], "left")
    out = whole.select(
        F.nullif("doc", F.lit(LAST)).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(b""), 256)).otherwise(F.lower(F.hex(F.coalesce("kept", "sha")))).alias("kept_sha256"),
        "repeats",
        *([F.col("text").alias("cut_text"), "copy", "doc", "tk"] if with_text else []),
    )
    if not with_text:
        return out
    as_words = F.trim(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " "))
    intact = _texts(docs).select("doc", F.decode("text", "UTF-8").alias("text")).withColumn("words", as_words)
    intact = intact.select("doc", F.sha2(F.col("words").cast("binary"), 256).alias("words_sha"), "words").dropDuplicates(["doc", "words_sha"])
    described_sha = marked.select("doc", "tk", F.lower(F.hex("sha")).alias("words_sha")).dropDuplicates(["doc", "tk"])
    intact = intact.join(described_sha, ["doc", "words_sha"]).select("doc", "tk", "words")
    text = F.when(F.col("copy"), F.lit("")).otherwise(F.coalesce(F.decode("cut_text", "UTF-8"), "words", F.lit("")))
    return out.join(intact, ["doc", "tk"], "left").select("doc_id", "n_words", "n_removed", "kept_sha256", "repeats", text.alias("text"))


ORACLE = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {{documents}}),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + {LENGTH - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {LENGTH - 2})) AS s FROM words)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {LENGTH})) AS i FROM later),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM places p ANTI JOIN gone g USING (doc_id, i) GROUP BY p.doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
