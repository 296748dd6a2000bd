"""Pattern packing of tokenised documents into sequences of a fixed size.

1. Documents become token ids and are cut into pieces of at most ``CAPACITY``
   tokens. A table of the pieces (without the ids) is written once.
2. Only the histogram of their lengths, one row per length, goes to the driver.
3. Patterns of one to three lengths that fill a sequence are enumerated, on
   lengths rounded up to ``WIDTH`` tokens. A non-negative least-squares fit
   (active set) finds how often each pattern must be repeated for the
   histogram, and the counts are rounded down. A pattern is then laid out in
   real lengths: the longest that round to its own, but for the last, which
   must fill the sequence exactly. It ends early where such pieces run out.
4. What is left over is packed best-fit decreasing, into the gaps of the
   patterns first, still on the histogram: all pieces of a length are placed
   together.
5. The plan is a list of slots: pieces number a to b of a length go to
   sequences s, s + 1, ... at one offset. Its size depends on ``CAPACITY``
   only, so it is broadcast. Pieces are numbered within their length from
   counts per task and a running sum over the tasks.

Defined results: a null text is an empty one, which is the single end id. A
null doc_id is an ordinary value. Repeated rows are packed each for itself. An
empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers

CAPACITY = 2048
WIDTH = 16  # lengths are rounded up to so many tokens in the fit
VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 800_000  # words whose ids a Python worker keeps, and a quarter as many parts of words, some 200 MB; it forgets them all when it has more
END = array("I", [0]).tobytes()

_PLAIN = re.compile(rb"[!-~]+")
_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")  # the vocabulary's own split, for ASCII


class Encoder(dict):
    """Ids of words (runs without ASCII white space) as bytes, 4 for each id.

    The vocabulary never joins anything across white space, so a text's ids are
    those of its words. Plain ASCII words are split further as the vocabulary
    does it; their parts come up again and again."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if _PLAIN.fullmatch(word) and b"<|" not in word:
            ids = b"".join([self.parts.get(x) or self._part(x) for x in _PARTS.findall(word.lower())])
        else:
            ids = array("I", self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids
        return ids

    def _part(self, part: bytes) -> bytes:
        if len(self.parts) >= REMEMBERED // 4:
            self.parts.clear()
        self.parts[part] = ids = array("I", [x.id for x in self.tokenizer.model.tokenize(part.decode())]).tobytes()
        return ids

    def ids(self, text: bytes | None) -> bytes:
        """Ids of a text and the end id, little-endian unsigned 32-bit."""
        text = text or b""
        if b"<|" not in text:  # the vocabulary lower-cases all but the names of its special tokens
            text = text.lower()
        return b"".join([*map(self.__getitem__, text.split()), END])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    """One for each Python worker, kept from task to task. A path of None is the public vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part and k (the k-th piece of
    its length in task ``part``), and the ids if asked for."""
    narrow = on_workers(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, encode = TaskContext.get().partitionId(), [0] * (capacity + 1), encoder(vocabulary).ids
        for batch in batches:
            owner, rows = [], []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py())
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    owner.append(i)
                    rows.append((piece, at // 4, n, crc32(own), part, seen[n], np.frombuffer(own, np.uint32) if with_ids else None))
                    seen[n] += 1
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner, pa.int64())), *arrays], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "k", "ids"])

    found = narrow.mapInArrow(each, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, k long, ids array<int>")
    return found if with_ids else found.drop("ids")


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All patterns of one to three lengths with sum ``capacity``, as rows of
    three lengths, zero where it has fewer. ``present``: by length, whether it occurs."""
    rows = [(capacity, 0, 0)] if present[capacity] else []
    rows += [(a, capacity - a, 0) for a in range(1, capacity // 2 + 1) if present[a] and present[capacity - a]]
    for a in range(1, capacity // 3 + 1):
        if present[a]:
            b = np.arange(a, (capacity - a) // 2 + 1)
            b = b[present[b] & present[capacity - a - b]]
            rows += [(a, x, capacity - a - x) for x in b.tolist()]
    return np.array(rows, np.int64).reshape(-1, 3)


def least_squares(columns: np.ndarray, goal: np.ndarray, rounds: int = 400, at_once: int = 24) -> np.ndarray:
    """x >= 0 that brings the patterns' lengths close to ``goal`` (by length, 0
    unused), by the active-set method; several patterns enter in a round."""
    n, x, active = len(columns), np.zeros(len(columns)), np.zeros(0, np.int64)
    full = np.zeros((len(goal), n), np.float32)
    for c in range(columns.shape[1]):
        np.add.at(full, (columns[:, c], np.arange(n)), 1)
    full[0] = 0
    for _ in range(rounds):
        left = goal - full[:, active] @ x[active]
        gain = left[columns].sum(axis=1) - (columns == 0) @ np.full(columns.shape[1], left[0])
        gain[active] = 0
        best = np.argsort(-gain)[:at_once]
        best = best[gain[best] > 0.25]
        if not len(best):
            break
        active = np.concatenate([active, best])
        while True:
            a = full[:, active].astype(np.float64)
            want = np.linalg.solve(a.T @ a + 1e-6 * np.eye(len(active)), a.T @ goal)
            if (want > 1e-9).all():
                x[active] = want
                break
            low = want <= 1e-9
            step = np.min(x[active][low] / np.maximum(x[active][low] - want[low], 1e-12))
            x[active] += step * (want - x[active])
            gone = low & (x[active] <= 1e-9)
            x[active[gone]] = 0
            active = active[~gone]
            if not len(active):
                break
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY, width: int = WIDTH) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first, last + 1, sequence, offset): piece number first + i
    of the length goes to sequence + i at the offset. ``histogram``: pieces by length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    used = np.zeros(capacity + 1, np.int64)  # pieces of each length that have a slot
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of sequences (first, number)
    sizes: list[int] = []  # those of gaps, ascending
    sequences = 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        slots.append((length, int(used[length]), int(used[length]) + n, sequence, offset))
        used[length] += n

    def free(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                insort(sizes, room)
            gaps.setdefault(room, []).append((first, n))

    bins = -(-np.arange(capacity + 1) // width)
    goal = np.bincount(bins, count, minlength=bins[-1] + 1).astype(float)
    if capacity % width == 0 and goal.sum():
        columns = patterns(capacity // width, goal > 0)
        times = np.floor(least_squares(columns, goal) + 1e-6).astype(np.int64) if len(columns) else np.zeros(0, np.int64)
        lengths = {b: [x for x in range(b * width, (b - 1) * width, -1) if x <= capacity] for b in range(1, bins[-1] + 1)}
        for p in np.argsort(-times, kind="stable").tolist():
            parts, todo = [b for b in columns[p].tolist() if b], int(times[p])
            while todo > 0:
                exact: list[int] = []  # the longest length of each part that still has pieces; the last part fills what is left
                for b in parts[:-1]:
                    exact.append(next((x for x in lengths[b] if count[x] - used[x] - exact.count(x) > 0), 0))
                room = capacity - sum(exact)
                exact.append(room if room > 0 and count[room] - used[room] - exact.count(room) > 0 else 0)
                if not all(exact):
                    break
                n = min(todo, *((count[x] - used[x]) // exact.count(x) for x in exact))
                n, offset = int(n), 0
                for x in exact:
                    put(x, n, sequences, offset)
                    offset += x
                free(capacity - offset, sequences, n)
                sequences += n
                todo -= n
    for length in range(capacity, 0, -1):  # best fit: the fullest sequence that still has room
        while (left := int(count[length] - used[length])) > 0:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                room = sizes[at]
                first, n = gaps[room].pop()
                if not gaps[room]:
                    del gaps[room], sizes[at]
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            fits = room // length
            whole = min(n, left // fits)
            for j in range(fits if whole else 0):
                put(length, whole, first, capacity - room + j * length)
            free(room - fits * length, first, whole)
            if whole < n:
                some = left - whole * fits if left < n * fits else 0
                for j in range(some):
                    put(length, 1, first + whole, capacity - room + j * length)
                free(room - some * length, first + whole, 1 if some else 0)
                rest = whole + (1 if some else 0)
                free(room, first + rest, n - rest)
    return slots


def _place(cut_pieces: DataFrame, capacity: int, width: int) -> DataFrame:
    spark = cut_pieces.sparkSession
    per_task = cut_pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = cut(per_task.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    histogram = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length
    slots = spark.createDataFrame(plan(histogram, capacity, width), "of long, first long, last long, sequence long, offset long")
    ranked = cut_pieces.join(base.drop("n"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("k"))
    here = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked.join(F.broadcast(slots), here).withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first"))


def pack(docs: DataFrame, capacity: int = CAPACITY, width: int = WIDTH, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    placed = _place(cut(pieces(docs, capacity, vocabulary), "pieces"), capacity, width)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, capacity: int = CAPACITY, width: int = WIDTH, vocabulary: str | None = None) -> DataFrame:
    """The packed sequences: sequence_id, ids (at most ``capacity``), lengths of
    the pieces in order (for an attention mask that keeps them apart), doc_ids."""
    placed = _place(cut(pieces(docs, capacity, vocabulary, with_ids=True), "pieces"), capacity, width)
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"), F.col("p.doc_id").alias("doc_ids"))
