"""Exact top-k search with multi-resolution segment statistics.

The score is the integer inner product, q.x = (|q|^2 + |x|^2 - d^2) / 2 with d
the Euclidean distance: the highest scores belong to the candidates with the
smallest d^2 - |x|^2. For a split of the components into segments of length L,
with mean m and deviation s of a vector in each,

    d^2 >= sum over segments of L * ((mq - mx)^2 + (sq - sx)^2)

and the finer the split, the closer the bound. Distances stay the same when all
vectors are moved, so before the split one half of each segment is moved up and
the other half down, further than any component reaches: a deviation then tells
which half is the larger one, and segments of two components lose nothing. The
splits are 1, 4, 16, ... segments and at last segments of two.

A pair is excluded only if its bound puts its score below the k-th best exact
score known for the query, with a margin for rounding, so the result is exact.
Candidates are taken in pieces. The best exact scores of a piece raise the
threshold for the next, and each resolution sees only the pairs that the
coarser one could not exclude; a resolution that excludes next to nothing in a
piece is left out in the next one. The exact score is computed for survivors.

Queries and candidates are dealt into blocks of bounded size by a hash of
their id, and each pair of blocks is one cell, computed by one task in bounded
memory. A candidate is copied once for every ``QUERIES`` queries. Cells return
at most k rows for each query; the k best of these are found by a ranking that
is cut to k in each task first.

Defined results: vectors that are null or hold a null or a component that is
not finite take no part, nor do rows without an id. Only vectors of the
query's own length are compared with it. Rows that repeat an id count once;
if their vectors differ, the smallest array counts. A query's own id is never
its result. Ties go to the smaller id. A component x is taken as
floor(256 * x); vectors so long that a score may not fit in a long raise. An
empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers

K = 5
SCALE = 256
EVERY = 50
QUERIES = 8192  # queries in a block
CANDIDATES = 16_384  # candidates in a block
SPREAD = 16  # blocks of candidates that are made at least, if there are PIECE for each
PIECE = 2048  # candidates that are compared at once
ROWS = 512  # queries that are compared at once
IDLE = 0.02  # a resolution that excludes a smaller share is left out in the next piece


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long): one row per id, of the vectors that take part."""
    x = F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))

    def bad(v: Column) -> Column:
        d = v.cast("double")
        return v.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))

    whole = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad)
    return vectors.select("vec_id", "embedding").where(whole).select("vec_id", x.alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))


def _levels(dim: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16, ..., and at last segments of two components."""
    found, n = [], 1
    while n < dim // 2:
        found.append(n)
        n *= 4
    return [*found, -(-dim // 2)] if dim else []


def _statistics(x: np.ndarray, segments: int, far: float) -> np.ndarray:
    """Weighted means and deviations, after a move of each half segment by
    ``far`` up or down. The distance of two such rows bounds that of the vectors from below."""
    edges = np.linspace(0, x.shape[1], segments + 1).round().astype(int)
    size = np.diff(edges)
    place = np.arange(x.shape[1]) - np.repeat(edges[:-1], size)
    x = x + np.where(2 * place < np.repeat(size, size), far, -far)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    rest = x - np.repeat(mean, size, axis=1)
    deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1) / size)
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([size, size]))


def _scores(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, in bounded pieces."""
    out = np.empty(len(qi), np.int64)
    for at in range(0, len(qi), 1 << 16):
        out[at : at + (1 << 16)] = np.einsum("ij,ij->i", q[qi[at : at + (1 << 16)]], x[xi[at : at + (1 << 16)]])
    return out


class _Side:
    """The vectors of one side with their statistics at every resolution."""

    def __init__(self, x: np.ndarray, levels: list[int], far: float):
        self.x, f = x, x.astype(np.float64)
        self.norm = np.einsum("ij,ij->i", f, f)
        self.stats = [_statistics(f, n, far) for n in levels]
        self.squares = [np.einsum("ij,ij->i", v, v) for v in self.stats]


def _highest(q: _Side, x: _Side, level: int, i: slice, j: slice) -> np.ndarray:
    """The highest score that the lower bound of the distance allows, for all pairs of two pieces."""
    a, b = q.stats[level][i], x.stats[level][j]
    sa, sb = q.squares[level][i, None], x.squares[level][None, j]
    rounding = 1e-14 * (a.shape[1] + 8) * np.sqrt(sa.max(initial=0) * sb.max(initial=0)) + 0.5
    return (q.norm[i, None] - sa + x.norm[None, j] - sb) / 2 + a @ b.T + rounding


def search(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int = K, seen: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of the k best candidates of each query;
    ``q``, ``x``: integers, a row each. ``seen`` counts pairs and exact scores."""
    if not len(q) or not len(x):
        return (np.zeros(0, np.int64),) * 3
    order = np.argsort(x_ids)  # equal scores: smaller ids first
    x_ids, x = x_ids[order], x[order]
    levels = _levels(q.shape[1])
    far = 1.0 + 2 * float(max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)))
    left, right = _Side(q, levels, far), _Side(x, levels, far)
    if left.norm.max() * right.norm.max() >= 2.0**126:
        raise OverflowError("vectors are too long for their scores to fit in a long")
    found = []
    for at in range(0, len(q), ROWS):
        rows = slice(at, min(at + ROWS, len(q)))
        found.append(_of_rows(left, right, rows, q_ids[rows], x_ids, k, len(levels), seen))
    qi, xi, score = (np.concatenate(c) for c in zip(*found, strict=True))
    return q_ids[qi], x_ids[xi], score


def _of_rows(left: _Side, right: _Side, rows: slice, q_ids: np.ndarray, x_ids: np.ndarray, k: int, n_levels: int, seen: dict | None):
    """The best of some queries over all candidates, piece by piece: query and candidate rows, scores."""
    n, last = rows.stop - rows.start, n_levels - 1
    threshold = np.full(n, -np.inf)
    qi, xi, score = (np.zeros(0, np.int64),) * 3
    used = set(range(last))
    for at in range(0, len(x_ids), PIECE):
        piece = slice(at, min(at + PIECE, len(x_ids)))
        allowed = q_ids[:, None] != x_ids[None, piece]
        pairs = allowed.sum()
        finest = None
        if not at and last >= 0:  # the best by the finest bound give each query its first threshold
            finest = _highest(left, right, last, rows, piece)
            finest[~allowed] = -np.inf
            m = min(k, finest.shape[1])
            probe = np.argpartition(-finest, m - 1, axis=1)[:, :m]
            first = _scores(left.x, right.x, np.repeat(np.arange(rows.start, rows.stop), m), piece.start + probe.ravel()).reshape(n, m).astype(np.float64)
            first[~np.take_along_axis(allowed, probe, axis=1)] = -np.inf
            if m == k:
                threshold = first.min(axis=1)
            _count(seen, "exact", probe.size)
        for level in sorted(used):
            before = allowed.sum()
            allowed &= _highest(left, right, level, rows, piece) >= threshold[:, None]
            if before - allowed.sum() < IDLE * before:
                used.discard(level)
        if last >= 0 and allowed.any():
            allowed &= (_highest(left, right, last, rows, piece) if finest is None else finest) >= threshold[:, None]
        i, j = np.nonzero(allowed)
        _count(seen, "pairs", pairs)
        _count(seen, "exact", len(i))
        qi, xi = np.concatenate([qi, rows.start + i]), np.concatenate([xi, piece.start + j])
        score = np.concatenate([score, _scores(left.x, right.x, rows.start + i, piece.start + j)])
        order = np.lexsort((xi, -score, qi))
        qi, xi, score = qi[order], xi[order], score[order]
        best = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        qi, xi, score = qi[best], xi[best], score[best]
        full = np.bincount(qi - rows.start, minlength=n) == k
        worst = np.full(n, np.inf)
        np.minimum.at(worst, qi - rows.start, score.astype(np.float64))
        threshold = np.where(full, np.maximum(threshold, worst), threshold)
    return qi, xi, score


def _count(seen: dict | None, what: str, n: int) -> None:
    if seen is not None:
        seen[what] = seen.get(what, 0) + int(n)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), dim)


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best candidates of each
    query. ``is_query`` is a condition on vec_id, by default that it is divisible by ``EVERY``."""
    is_query = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    rows = cut(integers(on_workers(vectors), scale), "vectors").withColumn("dim", F.size("x"))
    asked = rows.where(is_query)
    n = rows.count()
    q_blocks, x_blocks = max(1, -(-asked.count() // QUERIES)), max(1, -(-n // CANDIDATES), min(SPREAD, n // PIECE))
    hashed = F.xxhash64("vec_id")
    asked = asked.select("dim", F.pmod(hashed, F.lit(q_blocks)).alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(x_blocks - 1).cast("long"))).alias("xb"), "vec_id", "x")
    others = rows.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("qb"), F.pmod(hashed, F.lit(x_blocks)).alias("xb"), "vec_id", "x")

    def each(cell: tuple, q: pa.Table, x: pa.Table) -> pa.Table:
        dim = (cell[0].as_py() if q.num_rows else 0)
        if not q.num_rows or not x.num_rows:
            found = (np.zeros(0, np.int64),) * 3
        else:
            found = search(q.column("vec_id").to_numpy(), _matrix(q.column("x"), dim), x.column("vec_id").to_numpy(), _matrix(x.column("x"), dim), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    cells = asked.groupBy("dim", "qb", "xb").cogroup(others.groupBy("dim", "qb", "xb"))
    found = cells.applyInArrow(each, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH ints AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE}::DOUBLE * v::DOUBLE) AS BIGINT)) AS x FROM {{embeddings}}
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
named AS (SELECT vec_id, min(x) AS x FROM ints GROUP BY vec_id),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[]) AS BIGINT) AS score
  FROM named q JOIN named c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
