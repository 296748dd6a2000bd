"""Language identification by a linear-chain conditional random field.

Every word of a text is labelled with a language. Its evidence is the sum of
learned weights of hashed features: the word itself (lexicon), its first and
last three bytes (affixes), and all byte trigrams within it and over its edges.
Learned transitions join neighbouring words, so that a passage in another
language is labelled as such. Forward-backward gives the probability of each
label for each word; a document's language is the label with the largest sum
over all its words, and its score is that label's share.

A text is one chain, however long. It is computed in pieces of ``CHAIN`` words:
the transfers of all pieces are multiplied out together, a word at a time, then
the messages between pieces are passed on through each text, then all pieces
are computed with the messages that reach them. Texts beyond ``CHUNK`` bytes go
block by block, twice, with the messages at the borders of blocks kept.

Training sees a bounded sample: per language the ``DOCS`` documents with the
smallest hash of their id, and ``CHAINS`` chains of each, spread evenly over
its text. All words of a chain start with the label of their document. After
the first round the words that the model is sure belong to another language
(code-switched passages) get that label, and training goes on: this is what
the transitions between languages are learned from.

Defined results: a null text, or one without a letter, is ``und`` with score 0.
Rows without a language are not learned from. A null doc_id counts as an empty
text in the fold. Repeated rows get the same result each. Where nothing can be
learned (no labelled rows), every text is ``und``. Of languages with equal
sums the first in alphabetical order is taken. An empty table gives an empty
result. Further columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers, smallest_hashes, unfold, with_row
from tempora.llm.hashing import range_hashes

DOCS = 500  # documents learned from, for each language
CHAINS = 8  # chains learned from, for each document
CHAIN = 64  # words of a chain learned from, and of a piece of a text
TABLE = 18  # bits of a feature's place in the table of weights
CHUNK = 1 << 20  # bytes of text that are computed at once
EPOCHS = (4, 3)  # before and after words are labelled anew
SURE = 0.9
UNKNOWN = "und"
MIN_SCORE = 0.4  # share of a text's words that its language needs in the pipeline

_LETTER = re.compile(rb"[A-Za-z]")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


class Features:
    """Words of a text and the places of their features in the table."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(b" " + text.lower() + b"  ", np.uint8).copy()
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        raw[space] = 32
        edge = space[1:] != space[:-1]
        at = np.flatnonzero(edge) + 1
        starts, ends = at[::2], at[1::2]
        self.n = len(starts)
        wide = raw.astype(np.uint32)
        grams = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
        low = starts - 1

        def place(code: np.ndarray, salt: int) -> np.ndarray:
            return ((code ^ np.uint32(salt)) * np.uint32(2654435761)) >> np.uint32(32 - TABLE)

        head = np.where(ends - starts > 1, grams[starts], grams[starts] & np.uint32(0xFFFF) | np.uint32(32 << 16))  # no byte of the next word
        last = np.maximum(ends - 3, low)
        tail = wide[last] | wide[np.maximum(ends - 2, low)] << np.uint32(8) | wide[ends - 1] << np.uint32(16)
        self.words = np.stack(
            [
                (range_hashes(raw, starts, ends) >> np.uint64(64 - TABLE)).astype(np.uint32),
                place(head, 0x51000000),
                place(tail, 0xA3000000),
            ],
            axis=1,
        )
        self.grams = place(grams, 0)
        self.spans = np.stack([low, ends - 1], axis=1).ravel()  # trigrams of each word, and those between words

    def evidence(self, weights: np.ndarray) -> np.ndarray:
        """A row of scores by label for each word."""
        if not self.n:
            return np.zeros((0, weights.shape[1]), np.float32)
        inside = np.add.reduceat(weights[self.grams], self.spans, axis=0)[::2]
        return inside + weights[self.words].sum(axis=1)

    def add(self, gradient: np.ndarray, to: np.ndarray) -> None:
        """The gradient by word and label, summed by feature."""
        size = np.diff(self.spans)[::2]
        word = np.repeat(np.arange(self.n), size)
        at = np.repeat(self.spans[::2] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(len(word))
        places = np.concatenate([self.grams[at], self.words.ravel()])
        owner = np.concatenate([word, np.repeat(np.arange(self.n), self.words.shape[1])])
        for label in range(to.shape[1]):
            to[:, label] += np.bincount(places, gradient[owner, label], minlength=len(to))


def marginals(evidence: np.ndarray, first: np.ndarray, step: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label for each word, and the expected number of each
    transition. ``evidence``: words of all chains in a row; ``lengths``: words of each chain."""
    n, width, labels = len(lengths), int(lengths.max(initial=1)), evidence.shape[1]
    inside = np.arange(width)[None, :] < lengths[:, None]
    e = np.ones((n, width, labels), np.float64)
    e[inside] = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    a, start = np.exp(step - step.max()), np.exp(first - first.max())
    e = np.ascontiguousarray(e.transpose(1, 0, 2))
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for t in range(width):
        x = (start[None, :] if t == 0 else alpha[t - 1] @ a) * e[t]
        alpha[t] = x / x.sum(axis=1, keepdims=True)
    pairs = np.zeros((labels, labels))
    for t in range(width - 1, 0, -1):
        back = e[t] * beta[t]
        x = back @ a.T
        valid = inside[:, t]
        x /= x.sum(axis=1, keepdims=True)
        beta[t - 1] = np.where(valid[:, None], x, 1.0)
        joint = (alpha[t - 1][valid].T / np.maximum(np.einsum("ij,jk,ik->i", alpha[t - 1][valid], a, back[valid]), 1e-300)) @ back[valid] if valid.any() else 0
        pairs += joint * a
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    return p.transpose(1, 0, 2)[inside], pairs


def _normed(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


class Lattice:
    """Whole texts as chains, computed in pieces of CHAIN words. ``evidence``: words
    of all texts in a row; ``counts``: words of each text.

    Values of words are kept word number within the piece first, then by piece,
    longest piece first: those of one number are a slice."""

    def __init__(self, evidence: np.ndarray, counts: np.ndarray, step: np.ndarray):
        counts = np.asarray(counts, np.int64)
        own = -(-counts // CHAIN)  # pieces of each text
        self.n, self.k = int(own.sum()), evidence.shape[1]
        number = np.arange(self.n) - np.repeat(np.cumsum(own) - own, own)
        lengths = np.minimum(CHAIN, np.repeat(counts, own) - CHAIN * number)
        order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(self.n, np.int64)
        self.rank[order] = np.arange(self.n)
        self.width = int(lengths.max(initial=0))
        self.active = np.array([np.searchsorted(-lengths[order], -t) for t in range(self.width + 1)])  # pieces of more than t words
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        word = np.arange(len(evidence)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = self.offset[word] + np.repeat(self.rank, lengths)
        self.e = np.empty(evidence.shape, np.float64)
        self.e[self.place] = np.exp(evidence - evidence.max(axis=1, keepdims=True), dtype=np.float64)
        self.a = np.exp(step - step.max())
        by_size = np.argsort(-own, kind="stable")  # texts of most pieces first
        self.texts, self.pieces = by_size[own[by_size] > 0], own[by_size][own[by_size] > 0]
        self.begin = (np.cumsum(own) - own)[self.texts]
        self.through = self._transfers()

    def _at(self, t: int) -> slice:
        return slice(self.offset[t], self.offset[t] + self.active[t])

    def _transfers(self) -> np.ndarray:
        """For each piece, from the message before its first word to its last word."""
        if not self.n:
            return np.zeros((0, self.k, self.k))
        q = self.e[self._at(0)][:, :, None] * np.eye(self.k)
        for t in range(1, self.width):
            m = self.active[t]
            x = (q[:m].reshape(-1, self.k) @ self.a).reshape(m, self.k, self.k) * self.e[self._at(t)][:, None, :]
            q[:m] = x / x.max(axis=(1, 2), keepdims=True)
        return q[self.rank]

    def total(self) -> np.ndarray:
        """The transfer of the whole of a single text."""
        out = self.through[0]
        for q in self.through[1:]:
            out = out @ self.a @ q
            out /= out.max()
        return out

    def marginals(self, start: np.ndarray, leave: np.ndarray) -> np.ndarray:
        """Probability of each label for each word. ``start``: the message that
        reaches a text's first word, ``leave``: the one that reaches its last word from behind."""
        if not self.n:
            return np.zeros((0, self.k))
        reach, back = np.empty((self.n, self.k)), np.empty((self.n, self.k))
        reach[self.begin] = start
        longest = int(self.pieces[0])
        more = np.searchsorted(-self.pieces, -np.arange(longest))  # texts of more than j pieces
        for j in range(1, longest):
            at = self.begin[: more[j]] + j
            reach[at] = _normed(np.einsum("ik,ikl->il", reach[at - 1], self.through[at - 1]) @ self.a)
        back[self.begin + self.pieces - 1] = leave
        for j in range(longest - 1, 0, -1):
            at = self.begin[: more[j]] + j
            back[at - 1] = _normed(np.einsum("ikl,il->ik", self.through[at], back[at]) @ self.a.T)
        alpha, beta, by_rank = np.empty_like(self.e), np.empty_like(self.e), np.empty_like(back)
        alpha[self.rank] = reach
        by_rank[self.rank] = back
        alpha[self._at(0)] = _normed(alpha[: self.n] * self.e[self._at(0)])
        for t in range(1, self.width):
            before = alpha[self.offset[t - 1] : self.offset[t - 1] + self.active[t]]
            alpha[self._at(t)] = _normed((before @ self.a) * self.e[self._at(t)])
        for t in range(self.width - 1, -1, -1):
            on = self.active[t + 1]  # the others end here
            own = beta[self._at(t)]
            own[on:] = by_rank[on : self.active[t]]
            if on:
                own[:on] = _normed((self.e[self._at(t + 1)] * beta[self._at(t + 1)]) @ self.a.T)
        return _normed(alpha * beta)[self.place]


class Model:
    """Labels, feature weights, scores of the first label and of transitions."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels, self.weights = labels, np.zeros((1 << TABLE, k), np.float32)
        self.first, self.step = np.zeros(k), np.zeros((k, k))

    @property
    def start(self) -> np.ndarray:
        return np.exp(self.first - self.first.max())

    def words(self, text: bytes) -> np.ndarray:
        """Probability of each label for each word of a text of bounded size."""
        found = Features(text)
        return Lattice(found.evidence(self.weights), np.array([found.n]), self.step).marginals(self.start, np.ones(len(self.labels)))

    def sums(self, text: bytes) -> np.ndarray:
        """Sums of the words' probabilities of a text of any size, a block at a time."""

        def lattices() -> Iterator[Lattice]:
            for part in _chunks(text):
                found = Features(part)
                if found.n:
                    yield Lattice(found.evidence(self.weights), np.array([found.n]), self.step)

        starts, totals, reach, a = [], [], self.start, np.exp(self.step - self.step.max())
        for block in lattices():
            starts.append(reach)
            totals.append(block.total())
            reach = _normed(reach @ totals[-1] @ a)
        leaves = [np.ones(len(self.labels))]
        for total in totals[:0:-1]:
            leaves.append(_normed(a @ (total @ leaves[-1])))
        out = np.zeros(len(self.labels))
        for block, start, leave in zip(lattices(), starts, reversed(leaves)):
            out += block.marginals(start, leave).sum(axis=0)
        return out

    def fit(self, chains: list[tuple[bytes, int]], rate: float = 0.3, batch: int = 256, seed: int = 7) -> Model:
        """``chains``: text of at most CHAIN words and the number of its document's label."""
        random = np.random.default_rng(seed)
        order = random.permutation(len(chains))
        batches = []
        for at in range(0, len(order), batch):
            own = [chains[i] for i in order[at : at + batch]]
            features = Features(b" ".join(text for text, _ in own))
            lengths = np.array([len(text.split()) for text, _ in own])
            label = np.repeat([k for _, k in own], lengths)
            batches.append((features, lengths, label, label.copy()))
        k = len(self.labels)
        square = [np.full(x.shape, 1e-2) for x in (self.weights, self.first, self.step)]
        for part, epochs in enumerate(EPOCHS):
            if part:
                for features, lengths, label, given in batches:
                    p, _ = marginals(features.evidence(self.weights), self.first, self.step, lengths)
                    best = p.argmax(axis=1)
                    label[:] = np.where(p.max(axis=1) >= SURE, best, given)
            for _ in range(epochs):
                for b in random.permutation(len(batches)):
                    features, lengths, label, _ = batches[b]
                    p, pairs = marginals(features.evidence(self.weights), self.first, self.step, lengths)
                    wrong = p.copy()
                    wrong[np.arange(len(label)), label] -= 1
                    begin = np.cumsum(lengths) - lengths
                    inner = np.ones(len(label), bool)
                    inner[begin] = False
                    seen = np.zeros((k, k))
                    at = np.flatnonzero(inner)
                    np.add.at(seen, (label[at - 1], label[at]), 1)
                    gradients = [np.zeros(self.weights.shape), wrong[begin].sum(axis=0), pairs - seen]
                    features.add(wrong, gradients[0])
                    for x, g, s in zip((self.weights, self.first, self.step), gradients, square):
                        g /= len(own) if len(batches) == 1 else batch
                        s += g * g
                        x -= (rate * (g / np.sqrt(s) + 1e-4 * x)).astype(x.dtype)
        return self


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in parts of at least CHUNK bytes, cut at white space."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def train(docs: DataFrame, learn: Column, chains: int = CHAINS, per_language: int = DOCS) -> Model:
    """A model of the rows of ``docs`` that fulfil ``learn`` and have a language."""
    on_workers(docs)
    rows = docs.select("doc_id", "lang", learn.alias("learn")).where("learn and lang is not null").select("doc_id", "lang").distinct()
    chosen = smallest_hashes(rows, "lang", per_language)
    chosen = cut(chosen.select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang")), "sample")  # DOCS rows for each language

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, bytes]] = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                words = (text.as_py() or b"").split()
                starts = sorted({int(x) for x in np.linspace(0, max(0, len(words) - CHAIN), chains)}) if words else []
                out += [(lang, b" ".join(words[s : s + CHAIN])) for s in starts]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary())], ["lang", "text"])

    texts = docs.select("doc_id", "lang", F.col("text").cast("binary").alias("text"))
    texts = texts.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang")), "left_semi")
    sample = sorted((r["lang"], bytes(r["text"])) for r in texts.select("lang", "text").mapInArrow(each, "lang string, text binary").collect())
    labels = sorted({lang for lang, _ in sample})
    model = Model(labels)
    return model.fit([(text, labels.index(lang)) for lang, text in sample]) if sample else model


def predictor(model: Model, spark: SparkSession) -> Callable[[Column], Column]:
    """A function of a text column: struct of lang_pred and score."""
    sent = spark.sparkContext.broadcast(model)  # its size is that of the table of weights

    @F.pandas_udf("lang_pred string, score double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            texts = batch.tolist()
            sums = np.zeros((len(texts), max(1, len(own.labels))))
            if own.labels:
                for begin, group in _groups(texts):
                    sums[begin : begin + len(group)] = _document_sums(group, own)
            known = np.array([bool(own.labels) and bool(t) and has_letter(t) for t in texts], bool)
            best = sums.argmax(axis=1)
            share = sums[np.arange(len(texts)), best] / np.maximum(sums.sum(axis=1), 1e-9)
            lang = [own.labels[b] if ok else UNKNOWN for b, ok in zip(best, known)]
            yield pd.DataFrame({"lang_pred": lang, "score": np.where(known, share, 0.0)})

    return lambda text: each(text.cast("binary"))


def _groups(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about CHUNK bytes."""
    begin, group, size = 0, [], 0
    for i, t in enumerate(texts):
        group.append(t or b"")
        size += len(group[-1])
        if size >= CHUNK:
            yield begin, group
            begin, group, size = i + 1, [], 0
    if group:
        yield begin, group


def _document_sums(group: list[bytes], model: Model) -> list[np.ndarray]:
    """Sums of the words' probabilities for each text, all texts of a block's size at once."""
    out = []
    short = [t if len(t) <= CHUNK else b"" for t in group]
    counts = np.array([len(t.split()) for t in short], np.int64)
    found = Features(b" ".join(short))
    p = Lattice(found.evidence(model.weights), counts, model.step).marginals(model.start, np.ones(len(model.labels)))
    ends = np.cumsum(counts)
    total = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
    for text, n, end in zip(group, counts, ends):
        out.append(total[end] - total[end - n] if len(text) <= CHUNK else model.sums(text))
    return out


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score. Learns
    from the rows whose fold is not ``held_out``."""
    held = fold(F.col("doc_id"), folds) == held_out
    predict = predictor(train(docs, ~held), docs.sparkSession)
    found = docs.select("doc_id", held.alias("held_out"), predict(F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def known_language(docs: DataFrame, folds: int = 3, held_out: int = 1, min_score: float = MIN_SCORE, languages: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` in a language, with all their columns: the predicted
    language is known (one of ``languages``, if given) and at least ``min_score``
    of the words speak for it. Where nothing can be learned, no row has a language."""
    predict = predictor(train(docs, fold(F.col("doc_id"), folds) != held_out), docs.sparkSession)
    lang, score = F.col("p.lang_pred"), F.col("p.score")
    wanted = (lang != UNKNOWN) & (score >= min_score)
    if languages is not None:
        wanted &= lang.isin(languages)
    return unfold(with_row(docs, p=predict(F.col("text"))).where(wanted), docs)
