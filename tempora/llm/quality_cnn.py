"""Quality classifier: a byte-level convolutional network, in numpy.

A text is covered by overlapping chunks of ``CHUNK`` bytes, each starting half
a chunk after the one before; the last one ends with the text. Learned filters
look at ``WIDTH`` embedded bytes every ``STRIDE`` bytes; a chunk keeps the
largest response of each filter (max-pooling) and a hidden layer turns these
into the chunk's features. The document is combined from all its chunks: the
mean of their features goes through a logistic output into one probability.

Because every chunk counts, the cost of a text grows with its length, and
nothing of it is left out.

Training sees a bounded sample: for each label the ``DOCS`` labelled documents
with the smallest hash of their id, and up to ``SAMPLED`` chunks of each, taken
evenly over its text. The two classes are weighted so that the sample has the
shares of all labelled rows.

Defined results: a null or empty text is one chunk of padding and is scored
like any other. Rows without a quality label are not learned from; a doc_id
with several labels counts with the smallest. Where nothing can be learned
(no labels, or one class), every score is that class's share (0.5 without
labels). A null doc_id counts as an empty text in the fold. Repeated rows get
the same score. An empty table gives an empty result. Further columns play no
part.
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

DOCS = 1500  # documents learned from, for each label
SAMPLED = 6  # chunks learned from, for each document
CHUNK = 256
WIDTH = 8
STRIDE = 4
EMBED = 4
FILTERS = 32
HIDDEN = 16
EPOCHS = 20
LEAST = 0.3  # score from which a text is predicted to be good
BATCH = 1024  # chunks that are computed at once


def chunks(text: bytes | None) -> np.ndarray:
    """Overlapping chunks that cover the text, a row of bytes each, padded with 0."""
    raw = np.frombuffer(text or b"", np.uint8)
    if len(raw) <= CHUNK:
        out = np.zeros((1, CHUNK), np.uint8)
        out[0, : len(raw)] = raw
        return out
    rows = np.lib.stride_tricks.sliding_window_view(raw, CHUNK)
    starts = list(range(0, len(raw) - CHUNK, CHUNK // 2)) + [len(raw) - CHUNK]
    return rows[starts]


class Network:
    def __init__(self, share: float = 0.5, seed: int = 11):
        random = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * np.sqrt(2 / np.prod(shape[:-1]))).astype(np.float32)

        self.share, self.trained = share, False
        self.p = {
            "embed": random.standard_normal((256, EMBED)).astype(np.float32) * np.float32(0.5),
            "filter": draw(WIDTH * EMBED, FILTERS),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": draw(FILTERS, HIDDEN),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": draw(HIDDEN, 1),
            "out_bias": np.zeros(1, np.float32),
        }

    def _windows(self, rows: np.ndarray) -> np.ndarray:
        """The embedded bytes under each filter position: (chunk, position, WIDTH * EMBED)."""
        e = self.p["embed"][rows]
        view = np.lib.stride_tricks.sliding_window_view(e.reshape(len(rows), -1), WIDTH * EMBED, axis=1)
        return view[:, :: STRIDE * EMBED]

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows, the position of each filter's largest response, and that response."""
        w = self._windows(rows)
        n, m, k = w.shape
        response = (np.ascontiguousarray(w).reshape(n * m, k) @ self.p["filter"]).reshape(n, m, FILTERS)
        best = response.argmax(axis=1)
        top = np.take_along_axis(response, best[:, None, :], axis=1)[:, 0]
        return w, best, top + self.p["bias"]

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Features of chunks."""
        w = self._windows(rows)
        n, m, k = w.shape
        response = (np.ascontiguousarray(w).reshape(n * m, k) @ self.p["filter"]).reshape(n, m, FILTERS)
        top = np.maximum(response.max(axis=1) + self.p["bias"], 0)
        return np.maximum(top @ self.p["hidden"] + self.p["hidden_bias"], 0)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """The probability of each text, from all its chunks, in batches of BATCH chunks."""
        if not self.trained:
            return np.full(len(texts), self.share)
        total, count = np.zeros((len(texts), HIDDEN)), np.zeros(len(texts))
        owners, held, size = [], [], 0

        def flush() -> None:
            rows, own = np.concatenate(held), np.concatenate(owners)
            for at in range(0, len(rows), BATCH):
                np.add.at(total, own[at : at + BATCH], self.features(rows[at : at + BATCH]))
            np.add.at(count, own, 1)

        for i, text in enumerate(texts):
            rows = chunks(text)
            owners.append(np.full(len(rows), i))
            held.append(rows)
            size += len(rows)
            if size >= BATCH:
                flush()
                owners, held, size = [], [], 0
        if held:
            flush()
        z = (total / np.maximum(count, 1)[:, None]) @ self.p["out"] + self.p["out_bias"]
        return 1 / (1 + np.exp(-z[:, 0].clip(-40, 40)))

    def fit(self, documents: list[list[np.ndarray]], labels: np.ndarray, weights: np.ndarray, rate: float = 3e-3, batch: int = 64, seed: int = 13) -> Network:
        """``documents``: the sampled chunks of each; all parameters by Adam."""
        random, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for _ in range(EPOCHS):
            order = random.permutation(len(documents))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                sizes = np.array([len(documents[i]) for i in own])
                rows = np.concatenate([documents[i] for i in own])
                doc = np.repeat(np.arange(len(own)), sizes)
                g = self._gradients(rows, doc, sizes, labels[own], weights[own])
                step += 1
                for k, v in self.p.items():
                    first[k] += 0.1 * (g[k] - first[k])
                    second[k] += 0.001 * (g[k] ** 2 - second[k])
                    v -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        self.trained = True
        return self

    def _gradients(self, rows: np.ndarray, doc: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        w, best, top = self.pooled(rows)
        pool = np.maximum(top, 0)
        hidden = np.maximum(pool @ p["hidden"] + p["hidden_bias"], 0)
        mean = np.zeros((len(sizes), HIDDEN), np.float32)
        np.add.at(mean, doc, hidden)
        mean /= sizes[:, None]
        score = 1 / (1 + np.exp(-(mean @ p["out"] + p["out_bias"])[:, 0].clip(-40, 40)))
        wrong = ((score - labels) * weights / len(sizes))[:, None].astype(np.float32)
        back = (wrong @ p["out"].T / sizes[:, None])[doc] * (hidden > 0)
        to_pool = back @ p["hidden"].T * (top > 0)
        chunk = np.arange(len(rows))[:, None]
        under = w[chunk, best]  # the bytes under the largest response of each filter
        to_embed = np.einsum("nf,kf->nfk", to_pool, p["filter"]).reshape(-1, EMBED)
        at = (best * STRIDE)[:, :, None] + np.arange(WIDTH)
        embed = np.zeros_like(p["embed"])
        np.add.at(embed, rows[chunk[:, :, None], at].ravel(), to_embed)
        return {
            "embed": embed,
            "filter": np.einsum("nf,nfk->kf", to_pool, under),
            "bias": to_pool.sum(axis=0),
            "hidden": pool.T @ back,
            "hidden_bias": back.sum(axis=0),
            "out": mean.T @ wrong,
            "out_bias": wrong.sum(axis=0),
        }


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = DOCS) -> Network:
    """A network of the rows of ``docs`` that fulfil ``learn`` (a condition on doc_id) and have a quality label."""
    on_workers(docs)
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).where(learn)
    shares = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}  # one row for each label
    total = sum(shares.values())
    share = shares.get(1, 0) / total if total else 0.5
    if len(shares) < 2:
        return Network(share)
    chosen = smallest_hashes(marked, "quality", per_label)
    chosen = cut(chosen.withColumnRenamed("doc_id", "chosen_id"), "sample")  # DOCS rows for each label

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for text in batch.column("text"):
                rows = chunks(text.as_py())
                held.append(rows[sorted({int(x) for x in np.linspace(0, len(rows) - 1, SAMPLED)})].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(held, pa.binary())], ["doc_id", "quality", "chunks"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("doc_id", "quality", "text")
    found = texts.mapInArrow(each, "doc_id long, quality int, chunks binary").distinct().orderBy("doc_id", "chunks").limit(2 * 2 * per_label).collect()
    if len({r["quality"] for r in found}) < 2:
        return Network(share)
    documents = [np.frombuffer(bytes(r["chunks"]), np.uint8).reshape(-1, CHUNK) for r in found]
    y = np.array([r["quality"] for r in found], np.float32)
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Network(share).fit(documents, y, weights)


def scorer(model: Network, spark: SparkSession) -> Callable[[Column], Column]:
    """A function of a text column: its score."""
    sent = spark.sparkContext.broadcast(model)  # some thousands of numbers

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(sent.value.scores(batch.tolist()))

    return lambda text: each(text.cast("binary"))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted. Learns
    from the labels of the rows whose fold is not ``held_out``."""
    held = fold(F.col("doc_id"), folds) == held_out
    of = scorer(train(docs, labels, ~held), docs.sparkSession)
    found = docs.select("doc_id", held.alias("held_out"), of(F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= LEAST).cast("int"))
