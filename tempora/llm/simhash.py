"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``distance`` bits have a value between
them that each reaches by flipping at most half of those bits. So every
distinct fingerprint emits all variants within half the radius (2,081 of them
for a distance of 4) and fingerprints that emit the same variant collide.

The variants are shuffled in compressed form: a row (leading bits of the
variant, fingerprint) stands for all variants of the fingerprint with these
leading bits, and the task that owns the leading bits writes them out, sorts
them and finds those that collide. This moves some dozens of rows for each
fingerprint instead of thousands. A task splits its share further, bit by bit,
until the variants of a part fit in a fixed budget of memory.

All fingerprints around one variant lie within the distance of each other (at
least of the nearer ones, if the distance is odd), so a collision of m
fingerprints gives m - 1 links to its smallest one, not all pairs: no link
between different components is lost. Links are deduplicated in the task and
again after the shuffle, verified by their bit distance, and joined to
components.

Equal fingerprints are one point, whatever the number of documents that share
them: copies are combined before anything is shuffled.

Defined results: words are runs of bytes other than 0x20 and 0x09-0x0D, after
A-Z have been lower-cased. A text with fewer words than a shingle is one
shingle; a null text, or one without words, has fingerprint zero, which is
linked like any other. Null doc_ids rank last. Repeated rows share a
fingerprint. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tempora.llm.common import cut, on_workers, unfold, with_row
from tempora.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCK = 100_000  # shingles that are held at once
PART = 4_000_000  # variants that are held at once
POINTS = 65_536  # fingerprints to aim at for each leading-bits group
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: max(1, len(words) - shingle + 1)]
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())]
        as_bytes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        if len(hashes) < 400:
            ones += np.unpackbits(as_bytes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            ones += np.concatenate([np.bincount(as_bytes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (hash of the text, tells rows with one doc_id apart), fp (signed)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle) for x in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())], ["doc_id", "text_key", "fp"])

    narrow = on_workers(docs).select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(each, f"doc_id {kind}, text_key long, fp long")


@cache
def _flips(bits: int, f: int) -> np.ndarray:
    """All masks of ``bits`` bits with ``f`` ones."""
    return np.array([sum(1 << k for k in c) for c in combinations(range(bits), f)], np.uint64)


def _variants(bits: int, flips: int) -> int:
    return sum(comb(bits, f) for f in range(flips + 1))


def _collide(points: np.ndarray, left: np.ndarray, bits: int, near: int, found: list) -> None:
    """Collisions of the variants that agree with the prefix of this part in all
    but the ``bits`` lowest bits. ``points``: ascending fingerprints that can
    reach the prefix, ``left``: the flips that each has left; ``near``: flips
    that a variant must leave unused to count as near."""
    if len(points) < 2:
        return
    flips = int(left.max())
    per = np.array([_variants(bits, f) for f in range(flips + 1)])
    if per[left].sum() > PART and bits:  # split by the next bit; a point that has the other value pays a flip
        bit = (points >> np.uint64(bits - 1)) & np.uint64(1)
        for value in (0, 1):
            rest = left - (bit != value)
            ok = rest >= 0
            _collide(points[ok], rest[ok], bits - 1, near, found)
        return
    low = points & np.uint64((1 << bits) - 1)
    keys, owner, spare = [], [], []
    for f in range(min(flips, bits) + 1):
        who, masks = np.flatnonzero(left >= f), _flips(bits, f)
        keys.append((low[who, None] ^ masks[None, :]).ravel())
        owner.append(np.repeat(who, len(masks)))
        spare.append(np.repeat(left[who] - f, len(masks)))
    keys, owner, spare = map(np.concatenate, (keys, owner, spare))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    member = np.zeros(len(keys), bool)
    member[1:] |= same
    member[:-1] |= same
    order = order[member]
    if not len(order):
        return
    keys, owner, spare = keys[order], owner[order], spare[order]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    centre = np.where(spare >= near, owner, len(points))  # only near points can be the centre
    root = np.repeat(np.minimum.reduceat(centre, begin), np.diff(np.r_[begin, len(keys)]))
    ok = (root != owner) & (root < len(points))
    pairs = np.unique(root[ok] * len(points) + owner[ok])
    found.append(np.stack([points[pairs // len(points)], points[pairs % len(points)]]))


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) signed: links that join all of ``points`` (fp, distinct) within
    ``distance`` bits of each other to the same component."""
    half, near = (distance + 1) // 2, (distance + 1) // 2 - distance // 2
    size, lead = points.count(), 8
    while lead < 32 and size * _variants(lead, half) > POINTS << lead:
        lead += 1
    masks = [F.struct(F.lit(int(m)).alias("mask"), F.lit(half - f).alias("left")) for f in range(half + 1) for m in _flips(lead, f)]
    table = points.select("fp", F.explode(F.array(*masks)).alias("v"))
    table = table.select(F.shiftrightunsigned("fp", 64 - lead).bitwiseXOR(F.col("v.mask")).alias("prefix"), "fp", F.col("v.left").cast("int").alias("left"))

    def each(group: pa.Table) -> pa.Table:
        fps, left = group.column("fp").to_numpy().view(np.uint64), group.column("left").to_numpy()
        order, found = np.argsort(fps), [np.zeros((2, 0), np.uint64)]
        _collide(fps[order], left[order].astype(np.int64), 64 - lead, near, found)
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        ok = np.bitwise_count(a ^ b) <= distance
        return pa.table({"a": a[ok].view(np.int64), "b": b[ok].view(np.int64)})

    return on_workers(table).groupBy("prefix").applyInArrow(each, "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (fp, group) of all fingerprints."""
    prints = cut(fingerprints(docs, shingle), "fingerprints")
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = components(cut(links(points.select("fp"), distance), "collisions"))
    grouped = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("group"))
    return prints, cut(grouped, "groups")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id."""
    prints, grouped = _grouped(docs, shingle, distance)
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    by_print = cut(grouped.join(least, "group").select("fp", "component_id"), "components")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(by_print, "fp").select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    doc_id (null last; ties by a hash of the text, one of equal rows)."""
    prints, grouped = _grouped(docs, shingle, distance)
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    first = prints.groupBy("fp").agg(F.min(rank).alias("first")).join(grouped, "fp").groupBy("group").agg(F.min("first").alias("first"))
    stay = cut(first.select(F.col("first.doc_id").alias("stay_id"), F.col("first.text_key").alias("stay_key")), "stay")
    rows = with_row(docs, doc_id=F.col("doc_id"), text_key=F.xxhash64("text"))
    rows = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("text_key") == F.col("stay_key")), "left_semi")
    one = Window.partitionBy("doc_id", "text_key").orderBy("text_key")
    return unfold(rows.withColumn("place", F.row_number().over(one)).where("place = 1"), docs)
