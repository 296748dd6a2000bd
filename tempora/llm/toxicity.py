"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the character n-grams (3 to 5 code points, lower case) it
holds, hashed into a table of ``2 ** TABLE`` places; a place counts once for a
text, however often its n-grams occur. Training has two parts:

1. Corpus counts. Spark counts for every place the toxic and the clean texts
   that hold it, over all labelled rows that may be learned from. Place f gets
   the ratio ``r[f] = log((toxic[f] + s * t) / (clean[f] + s * (1 - t))) -
   log(t / (1 - t))``, with t the share of toxic texts and s the smoothing: a
   place that was never seen, or is as common in both, has ratio 0.
2. Weights. A logistic regression on the scaled features, z = bias + sum of
   r[f] * (c + d[f]), learns one weight c for all places and a difference d[f]
   for each, drawn towards 0. Where the sample says nothing about a place, its
   naive Bayes ratio still counts.

The counts come from all labelled texts. Only the regression sees a bounded
sample: for each label the ``DOCS`` labelled documents with the smallest hash
of their id. The classes are weighted so that the sample has the shares of all
labelled rows.

A text is read in blocks of ``BLOCK`` characters that overlap by an n-gram, and
every n-gram of it counts; what is held at once does not grow with its length.

Defined results: a null or empty text has no feature and gets the score of the
bias alone. Rows without a label, or without a doc_id, are not learned from; a
doc_id with several labels counts with the smallest. Where nothing can be
learned (no labels, or one class) every score is that class's share (0.5
without labels). A null doc_id counts as an empty text in the fold. Repeated
rows get the same score, and count as often as they occur when learned from.
An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers, smallest_hashes
from tempora.llm.language_id import fold

NGRAMS = (3, 4, 5)
TABLE = 20  # bits of a feature's place
DOCS = 1500  # documents the regression learns from, for each label
SMOOTHING = 4.0
EPOCHS = 16
BATCH = 64
PENALTY = 1e-4
LEAST = 0.3  # score from which a text is predicted to be toxic
BLOCK = 1 << 18  # characters of a text that are computed at once

_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2**64 divided by the golden ratio


def places(text: str, bits: int = TABLE) -> np.ndarray:
    """The place of each n-gram of ``text``, repeats included."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found, code = [], points.copy()
    for n in range(2, max(NGRAMS) + 1):
        if len(points) < n:
            break
        code = code[: len(points) - n + 1] * _ODD + points[n - 1 :]
        if n in NGRAMS:
            mixed = (code ^ (code >> np.uint64(29))) * _ODD
            found.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Features:
    """Finds the distinct places of one text after another. ``stamp`` holds for
    each place the last text that it was seen in."""

    def __init__(self, bits: int = TABLE):
        self.bits, self.stamp, self.first, self.text = bits, np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64), 0

    def blocks(self, text: str | None) -> Iterator[np.ndarray]:
        """Distinct places of the text, each in one of the arrays."""
        self.text += 1
        text = text or ""
        for at in range(0, max(len(text), 1), BLOCK):
            found = places(text[at : at + BLOCK + max(NGRAMS) - 1].lower(), self.bits)
            order = np.arange(len(found))
            self.first[found] = order
            found = found[(self.first[found] == order) & (self.stamp[found] != self.text)]
            self.stamp[found] = self.text
            yield found


class Model:
    def __init__(self, weights: np.ndarray | None = None, bias: float = 0.0, share: float = 0.5):
        self.weights, self.bias, self.share = weights, bias, share

    def scores(self, texts: Iterator[str | None], features: Features) -> np.ndarray:
        if self.weights is None:
            return np.array([self.share for _ in texts])
        z = np.array([self.bias + sum(float(self.weights[found].sum()) for found in features.blocks(t)) for t in texts])
        return 1 / (1 + np.exp(-z.clip(-40, 40)))


def ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, smoothing: float = SMOOTHING) -> np.ndarray:
    """The naive Bayes log-count ratio of each place."""
    t = n_toxic / (n_toxic + n_clean)
    return (np.log((toxic + smoothing * t) / (clean + smoothing * (1 - t))) - np.log(t / (1 - t))).astype(np.float32)


def regress(documents: list[np.ndarray], y: np.ndarray, weights: np.ndarray, r: np.ndarray, seed: int = 17) -> tuple[np.ndarray, float]:
    """Weights (r times the learned ones) and bias, by Adam over the documents' places."""
    random = np.random.default_rng(seed)
    sums = np.array([r[d].sum() for d in documents])
    common, bias, d = 1 / max(float(np.abs(sums).mean()), 1.0), 0.0, np.zeros_like(r)
    first, second = np.zeros_like(r), np.zeros_like(r)
    slow, fast, step = np.zeros(2), np.zeros(2), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(documents))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            places, inverse = np.unique(np.concatenate([documents[i] for i in own]), return_inverse=True)
            doc = np.repeat(np.arange(len(own)), [len(documents[i]) for i in own])
            scaled = r[places] * (common + d[places])
            z = bias + np.bincount(doc, scaled[inverse], len(own))
            wrong = (1 / (1 + np.exp(-z.clip(-40, 40))) - y[own]) * weights[own] / len(own)
            step += 1
            both = np.array([wrong @ sums[own], wrong.sum()])
            slow += 0.1 * (both - slow)
            fast += 0.001 * (both**2 - fast)
            move = (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.999**step)) + 1e-8)
            common, bias = max(common - 2e-4 * move[0], 0.0), bias - 2e-2 * move[1]
            g = np.bincount(inverse, wrong[doc], len(places)).astype(np.float32) * r[places] + np.float32(PENALTY) * d[places]
            first[places] += np.float32(0.1) * (g - first[places])
            second[places] += np.float32(0.001) * (g**2 - second[places])
            d[places] -= np.float32(2e-3) * first[places] / (np.sqrt(second[places] / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    return r * (np.float32(common) + d), bias


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the texts of one task: toxic and clean texts that hold each place."""
    features, held = Features(), np.zeros((2, 1 << TABLE), np.int32)
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            for found in features.blocks(text.as_py()):
                held[label, found] += 1
    seen = np.flatnonzero(held.any(axis=0))
    for at in range(0, len(seen), 1 << 16):
        part = seen[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(held[1, part]), pa.array(held[0, part])], ["place", "toxic", "clean"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct places of each sampled text, ascending."""
    features = Features()
    for batch in batches:
        held = [np.sort(np.concatenate(list(features.blocks(t.as_py())))).astype("<i4").tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(held, pa.binary())], ["doc_id", "toxic", "places"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = DOCS) -> Model:
    """A model of the rows of ``docs`` that fulfil ``learn`` (a condition on doc_id) and have a toxicity label."""
    on_workers(docs)
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"))
    marked = marked.where(learn & F.col("toxic").isin(0, 1)).withColumnRenamed("doc_id", "labelled")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(marked, F.col("doc_id") == F.col("labelled"))
    texts = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "toxic", "text")
    sizes = {x["toxic"]: x["n"] for x in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.5
    if len(sizes) < 2:
        return Model(share=share)
    counted = texts.select("toxic", "text").mapInArrow(_counts, "place int, toxic int, clean int")
    counted = counted.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()  # 2 ** TABLE rows at most
    toxic, clean = (np.bincount(counted["place"], counted[c], 1 << TABLE) for c in ("toxic", "clean"))
    r = ratios(toxic, clean, sizes[1], sizes[0])
    chosen = smallest_hashes(marked.withColumnRenamed("labelled", "doc_id"), "toxic", per_label)
    chosen = cut(chosen.select(F.col("doc_id").alias("chosen"), "toxic"), "toxic-sample")  # DOCS rows for each label
    few = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"))
    few = few.select(F.col("doc_id").cast("string").alias("doc_id"), "toxic", F.col("text"))
    few = few.mapInArrow(_sampled, "doc_id string, toxic int, places binary").distinct()
    found = few.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("places").alias("places")).orderBy("doc_id").collect()
    documents = [np.frombuffer(bytes(x["places"]), "<i4") for x in found]
    y = np.array([x["toxic"] for x in found], float)
    if not 0 < y.mean() < 1:
        return Model(share=share)
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(*regress(documents, y, weights, r), share)


def scorer(model: Model, spark: SparkSession) -> Callable[[Column], Column]:
    """A function of a text column: its score."""
    sent = spark.sparkContext.broadcast(model)  # 2 ** TABLE numbers

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for batch in batches:
            yield pd.Series(sent.value.scores(iter(batch), features))

    return lambda text: each(text.cast("string"))


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Learns
    from the labels of the rows whose fold is not ``held_out``."""
    held = fold(F.col("doc_id"), folds) == held_out
    of = scorer(train(docs, labels, ~held), docs.sparkSession)
    found = docs.select("doc_id", held.alias("held_out"), of(F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= LEAST).cast("int"))
