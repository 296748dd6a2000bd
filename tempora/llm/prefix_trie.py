"""Prefix trie of conversations, held as minimal-perfect-hash node tables of bounded shards.

Conversations that start alike share work (the key-value cache of a served
model, a packed training example). A node of the trie is a distinct sequence of
the first d turns; its members are the conversations that start with it.

1. Turns become narrow rows where they are read: the SHA-256 of role and text,
   and the number of words. They are dealt out by ranges of (conversation,
   turn) into shards of some ``SHARD`` turns. A conversation longer than that
   lies in several shards, in order; such a part is called a segment.
2. A prefix has a digest of 128 bits, the exclusive or of a hash of each turn
   and its depth. A turn's own hash leads from the digest to the parent's, and
   segments need only the digest of those before them (one row each).
3. Each shard enumerates the distinct digests of its turns and gives them slots
   0 to n - 1 by a minimal perfect hash. The digest is kept in its slot and
   every look-up is compared with it. Member counts, words, depths and parent
   slots are flat numpy arrays by slot.
4. One shuffle of these local nodes by digest finds, for each node of the whole
   trie, its smallest member (whose shard owns the node) and whether all of its
   members end there. Nodes whose turn or parent differ under one digest raise.
5. Each shard takes (members - 1) * words over its members, with the 1 counted
   by the owner only, and adds it up through the parent slots, deepest first.
   Leaves and children likewise. What lies in later segments of a conversation
   is added where its segment ends, and does not rise beyond where it starts. The sums of the shards add up to the node's.

No step holds more than a shard, whatever the number of members of a node or
the length of a conversation: a node is one row for each shard that has members
of it. The ids that end at a node are joined in pieces of ``PIECE`` ids and
hashed as a stream, the only step that is one task's work for one node.

Defined results: rows without a conv_id belong to no conversation. A null turn
comes first; rows of equal turns are ordered by the SHA-256 of role and text,
repeated rows are repeated turns. A null role or text is empty. An empty table
has no node. Further columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers, text_of

GROUP = 20  # conversations that may borrow from the same one
HEADS = 4  # a conversation borrows fewer turns than this
SHARD = 50_000  # turns
PIECE = 512  # ids that are hashed at once

WORD = r"[^\x20\x09-\x0D]++"
_EMPTY = hashlib.sha256(b"").hexdigest()
_LEVELS = 64


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys[:, 0] + keys[:, 1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys (rows of two 64-bit numbers). On
    each level the keys that are alone in their place take it, and the others
    go to the next; a key's slot is the rank of its place among those taken."""

    def __init__(self, keys: np.ndarray):
        self.levels, base, left = [], 0, keys
        while len(left):
            if len(self.levels) == _LEVELS:
                raise ValueError("keys repeat")
            size = 2 * len(left)
            place = _mixed(left, len(self.levels)) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            self.levels.append((np.uint64(size), alone, base + np.cumsum(alone) - alone))
            base += int(alone.sum())
            left = left[~alone[place]]
        self.keys = np.zeros_like(keys)
        self.keys[self.places(keys)] = keys

    def places(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key, right for those that the table was made of; -1
        for some of the others."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            place = _mixed(keys[todo], level) % size
            hit = alone[place]
            out[todo[hit]] = rank[place[hit]]
            todo = todo[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        found = self.places(keys)
        if len(self.keys):
            found[(self.keys[found] != keys).any(axis=1)] = -1
        return found


def _distinct(keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return keys
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return keys[np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])]


def _pair(table: pa.Table | pa.RecordBatch, a: str, b: str) -> np.ndarray:
    return np.stack([np.ascontiguousarray(table.column(c).to_numpy()).view(np.uint64) for c in (a, b)], axis=1)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the shard and the place of each turn among those of its conversation in the shard."""
    shard, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        first = starts[1] if len(starts) > 1 else len(conv)
        if conv[0] == last:
            place[:first] += n
        last, n = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), shard, np.int64)), batch.column("conv"), pa.array(place.astype(np.int64)), batch.column("sha"), batch.column("words")],
            ["shard", "conv", "place", "sha", "words"],
        )


def turns(conversations: DataFrame, per_shard: int = SHARD) -> DataFrame:
    """(shard, conv, place, sha, words) of each turn, written."""
    role, text = text_of("role"), text_of("text")
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("sha"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),  # equal rows may lie in several shards
    )
    shards = max(1, -(-conversations.count() // per_shard))
    keys = ["conv", "turn", "sha", "row"]
    rows = on_workers(rows.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).drop("turn", "row"))
    return cut(rows.mapInArrow(_numbered, "shard long, conv long, place long, sha binary, words long"), "trie-turns")


def _segments(own: DataFrame, group: int, heads: int) -> DataFrame:
    """One row for each conversation in each shard: shard, conv, before (its
    turns in earlier shards), segments, borrows, head (the turns it borrows),
    length (turns when rebuilt); written."""
    base = F.col("conv") - F.col("conv") % group
    few = F.when((F.col("conv") == base) & (F.col("place") < heads - 1), F.struct("place", "sha", "words"))
    found = own.groupBy("shard", "conv").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(few)).alias("first"))
    whole, earlier = Window.partitionBy("conv"), Window.partitionBy("conv").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumns({
        "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "total": F.sum("n").over(whole),
        "segments": F.count(F.lit(1)).over(whole),
    })
    found = cut(found, "trie-found")
    lent = found.where((F.col("conv") == base) & (F.col("before") < heads - 1)).groupBy(F.col("conv").alias("base"))
    in_order = F.sort_array(F.collect_list(F.struct("shard", "first")))  # a conversation's first turns lie in few shards
    lent = lent.agg(F.slice(F.flatten(F.transform(in_order, lambda x: x["first"])), 1, heads - 1).alias("lent"))
    borrows = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    joined = found.drop("first").withColumn("_base", base).join(lent, F.col("_base") == F.col("base"), "left")
    head = F.coalesce(F.slice("lent", F.lit(1), F.col("borrows")), F.array().cast("array<struct<place:bigint,sha:binary,words:bigint>>"))
    joined = joined.withColumn("borrows", borrows).withColumn("head", head)
    length = F.size("head") + F.greatest(F.col("total") - F.col("borrows"), F.lit(0))
    return cut(joined.select("shard", "conv", "before", "segments", "borrows", "head", length.alias("length")), "trie-segments")


def _rebuilt(own: DataFrame, segments: DataFrame) -> DataFrame:
    """The rebuilt turns, and the root (depth 0) of each conversation: shard, conv,
    depth, sha, words, length, segments, a and b (the two halves of the turn's hash)."""
    held = ["shard", "conv", "length", "segments"]
    place = F.col("before") + F.col("place")
    kept = own.join(segments, ["shard", "conv"]).where(place >= F.col("borrows"))
    kept = kept.select(*held, (place - F.col("borrows") + F.size("head") + 1).alias("depth"), "sha", "words")
    start = segments.where("before = 0")
    lent = start.select(*held, F.posexplode("head").alias("at", "turn"))
    lent = lent.select(*held, (F.col("at") + 1).cast("long").alias("depth"), F.col("turn.sha").alias("sha"), F.col("turn.words").alias("words"))
    root = start.select(*held, F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("sha"), F.lit(0).cast("long").alias("words"))
    rows = kept.unionByName(lent).unionByName(root)
    of_turn = F.col("depth") > 0
    a, b = F.xxhash64("depth", "sha"), F.xxhash64("sha", "depth", F.lit(1))
    return rows.withColumns({"a": F.when(of_turn, a).otherwise(F.lit(0)), "b": F.when(of_turn, b).otherwise(F.lit(0))})


_LOCAL = "shard long, slot long, parent_slot long, d1 long, d2 long, p1 long, p2 long, sha binary, depth long, words long, n long, conv long, n_ends long, ends array<string>"


def _enumerate(table: pa.Table) -> pa.Table:
    """The nodes of one shard by slot. Parents that lie in another shard come with no members (n = 0)."""
    conv, depth = table.column("conv").to_numpy(), table.column("depth").to_numpy()
    table = table.take(pa.array(np.lexsort((depth, conv))))
    conv, depth, words = (table.column(c).to_numpy() for c in ("conv", "depth", "words"))
    own, before = _pair(table, "a", "b"), _pair(table, "before1", "before2")
    starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
    sizes = np.diff(np.append(starts, len(conv)))
    running = np.bitwise_xor.accumulate(own, axis=0)
    earlier = np.where((starts > 0)[:, None], running[starts - 1], np.uint64(0))
    digest = running ^ np.repeat(earlier, sizes, axis=0) ^ before
    parent = digest ^ own
    below = depth > 0
    known = PerfectHash(_distinct(np.concatenate([digest, parent[below]])))
    slot, size = known.slots(digest), len(known.keys)
    up = known.slots(parent)

    first = np.zeros(size, np.int64)
    first[slot[::-1]] = np.arange(len(slot))[::-1]  # the row with the smallest conversation
    sha = np.array(table.column("sha").to_pylist(), object)
    one = first[slot]
    if (depth[one] != depth).any() or (parent[one] != parent).any() or (sha[one] != sha).any():
        raise ValueError("two prefixes have one digest")
    n = np.bincount(slot, minlength=size)
    held = n > 0
    parent_slot = np.where(held & (depth[first] > 0), up[first], -1)
    level = np.where(held, depth[first], 0)
    level[parent_slot[parent_slot >= 0]] = level[parent_slot >= 0] - 1
    ended = depth == table.column("length").to_numpy()
    ends = [None] * size
    order = np.argsort(slot[ended], kind="stable")  # conversations stay in order
    ids, at = conv[ended][order], slot[ended][order]
    n_ends = np.bincount(at, minlength=size)
    stops = np.cumsum(n_ends)
    for s in np.flatnonzero(n_ends):
        own_ids = ids[stops[s] - n_ends[s] : stops[s]].tolist()
        ends[s] = [",".join(map(str, own_ids[i : i + PIECE])) for i in range(0, len(own_ids), PIECE)]
    shard = table.column("shard")[0].as_py()

    def signed(x: np.ndarray) -> pa.Array:
        return pa.array(np.ascontiguousarray(x).view(np.int64))

    def members(x: np.ndarray) -> pa.Array:
        return pa.array(x, mask=~held)

    return pa.table({
        "shard": pa.array(np.full(size, shard)), "slot": pa.array(np.arange(size)), "parent_slot": pa.array(parent_slot),
        "d1": signed(known.keys[:, 0]), "d2": signed(known.keys[:, 1]), "p1": members(np.ascontiguousarray(parent[first, 0]).view(np.int64)),
        "p2": members(np.ascontiguousarray(parent[first, 1]).view(np.int64)), "sha": pa.array([s if h else None for s, h in zip(sha[first], held, strict=True)], pa.binary()),
        "depth": pa.array(level), "words": pa.array(np.where(held, words[first], 0)), "n": pa.array(n), "conv": members(conv[first]),
        "n_ends": pa.array(n_ends), "ends": pa.array(ends, pa.list_(pa.string())),
    })


_SUMS = "d1 long, d2 long, saved long, leaves long, children long, conv_id long, depth long, parent_conv_id long, n_convs long"


def _accumulate(nodes: pa.Table, later: pa.Table) -> pa.Table:
    """The shard's part of each node's sums, through the parent slots in depth
    order; what is the node's own comes from its owner."""
    nodes = nodes.take(pa.array(np.argsort(nodes.column("slot").to_numpy())))
    get = {c: nodes.column(c).to_numpy() for c in ("parent_slot", "depth", "words", "n", "n_convs", "n_all_ends", "shard", "owner")}
    parent, depth, n = get["parent_slot"], get["depth"], get["n"]
    rep = nodes.column("rep").to_numpy()
    own = (get["owner"] == get["shard"]) & (n > 0)
    saved = (n - own) * get["words"]
    leaves = (own & (get["n_all_ends"] == get["n_convs"])).astype(np.int64)
    children = np.bincount(parent[own & (parent >= 0)], minlength=len(parent))
    if later.num_rows:
        known = PerfectHash(_pair(nodes, "d1", "d2"))
        row = np.empty(len(parent), np.int64)
        row[known.slots(_pair(nodes, "d1", "d2"))] = np.arange(len(parent))
        at = row[known.slots(_pair(later, "d1", "d2"))]
        np.add.at(saved, at, later.column("saved").to_numpy())
        np.add.at(leaves, at, later.column("leaves").to_numpy())
    linked = np.flatnonzero(parent >= 0)
    linked = linked[np.argsort(-depth[linked], kind="stable")]
    for level in np.split(linked, np.flatnonzero(np.diff(depth[linked])) + 1):
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    here, top = n > 0, parent < 0
    emitted = here | (children > 0)
    out = pa.table({
        "d1": nodes.column("d1"), "d2": nodes.column("d2"), "saved": pa.array(np.where(here, saved, 0)), "leaves": pa.array(np.where(here, leaves, 0)),
        "children": pa.array(children), "conv_id": pa.array(rep, mask=~own), "depth": pa.array(depth, mask=~own),
        "parent_conv_id": pa.array(rep[np.where(top, 0, parent)], mask=~own | top), "n_convs": pa.array(get["n_convs"], mask=~own),
    })
    return out.filter(pa.array(emitted))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each node, its pieces coming in order."""
    last, state = None, None

    def row(key: tuple[int, int], digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([digest])], ["d1", "d2", "ends_sha256"])

    for batch in batches:
        keys, values = [], []
        for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids")), strict=True):
            if (d1, d2) != last:
                if last is not None:
                    keys.append(last)
                    values.append(state.hexdigest())
                last, state = (d1, d2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(values)], ["d1", "d2", "ends_sha256"])
    if last is not None:
        yield row(last, state.hexdigest())


def trie(conversations: DataFrame, per_shard: int = SHARD, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    own = turns(conversations, per_shard)
    segments = _segments(own, group, heads)
    rows = _rebuilt(own, segments)

    # Digests of the segments before; only conversations in several shards have any.
    parts = rows.where("segments > 1").groupBy("shard", "conv").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("words").alias("words"))
    earlier = Window.partitionBy("conv").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = parts.withColumns({"before1": F.coalesce(F.bit_xor("a").over(earlier), none), "before2": F.coalesce(F.bit_xor("b").over(earlier), none), "starts": F.count(F.lit(1)).over(earlier) == 0})
    parts = cut(parts, "trie-parts")
    rows = rows.join(parts.select("shard", "conv", "before1", "before2"), ["shard", "conv"], "left").fillna(0, ["before1", "before2"])
    local = cut(rows.groupBy("shard").applyInArrow(_enumerate, _LOCAL), "trie-local")

    def over_all(c: Column) -> Column:
        return c.over(Window.partitionBy("d1", "d2"))

    same = F.when(F.col("n") > 0, F.struct("p1", "p2", "sha", "depth"))
    rep = F.when(F.col("n") > 0, F.struct("conv", "shard"))
    nodes = local.drop("ends").select(
        "shard", "slot", "parent_slot", "d1", "d2", "depth", "words", "n",
        over_all(F.sum("n")).alias("n_convs"), over_all(F.sum("n_ends")).alias("n_all_ends"),
        over_all(F.min(rep)).alias("first"), (over_all(F.min(same)) == over_all(F.max(same))).alias("same"),
    )
    checked = F.when(F.col("same"), F.col("first.shard")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    nodes = cut(nodes.withColumn("rep", F.col("first.conv")).withColumn("owner", checked).drop("first", "same"), "trie-nodes")

    # What lies in later segments of a conversation: the words of its turns less those of nodes it owns, and the leaves it owns.
    mine = nodes.where("owner = shard and n > 0").groupBy("shard", F.col("rep").alias("conv"))
    mine = mine.agg(F.sum("words").alias("owned"), F.count_if(F.col("n_all_ends") == F.col("n_convs")).alias("leaves"))
    after = Window.partitionBy("conv").orderBy(F.desc("shard")).rowsBetween(Window.unboundedPreceding, -1)
    later = parts.join(mine, ["shard", "conv"], "left").fillna(0, ["owned", "leaves"]).withColumn("saved", F.col("words") - F.col("owned"))
    later = later.withColumns({f"{c}_after": F.coalesce(F.sum(c).over(after), none) for c in ("saved", "leaves")})
    # It is added where the segment ends. If the turn before a segment is a node of the segment's shard too, through
    # other members, then nothing may rise to it: the shard of the segment before has counted it.
    add = [F.col("before1").bitwiseXOR(F.col("a")), F.col("before2").bitwiseXOR(F.col("b")), F.col("saved_after"), F.col("leaves_after")]
    take = [F.col("before1"), F.col("before2"), -F.col("saved") - F.col("saved_after"), -F.col("leaves") - F.col("leaves_after")]
    names = ("d1", "d2", "saved", "leaves")
    later = later.select("shard", *[c.alias(x) for c, x in zip(add, names, strict=True)]).unionByName(
        later.where("not starts").select("shard", *[c.alias(x) for c, x in zip(take, names, strict=True)])
    )
    sums = nodes.groupBy("shard").cogroup(later.groupBy("shard")).applyInArrow(_accumulate, _SUMS)
    sums = sums.groupBy("d1", "d2").agg(
        *[F.sum(c).alias(c) for c in ("saved", "leaves", "children")], *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")]
    )
    pieces = local.where("n_ends > 0").select("d1", "d2", "shard", F.posexplode("ends").alias("piece", "ids"))
    pieces = pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "shard", "piece").select("d1", "d2", "ids")
    ends = pieces.mapInArrow(_ends, "d1 long, d2 long, ends_sha256 string")
    return sums.join(ends, ["d1", "d2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


# CRC-32 (reflected polynomial 0xEDB88320) of the decimal id, a byte and then a bit at a time.
ORACLE = r"""
WITH turns AS (SELECT conv_id AS c, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sha,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words FROM {conversations} WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha) - 1 AS i FROM turns),
convs AS (SELECT c, c - c % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda r, x: list_reduce(list_prepend(xor(r, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM numbered)),
rebuilt AS (
  SELECT convs.c, 0 AS part, i, sha, words FROM convs JOIN numbered ON numbered.c = base AND i < h
  UNION ALL SELECT convs.c, 1, i, sha, words FROM convs JOIN numbered ON numbered.c = convs.c AND i >= h),
placed AS (SELECT c, row_number() OVER w AS d, string_agg(sha, ',') OVER w AS k, string_agg(sha, ',') OVER v AS up, words FROM rebuilt
  WINDOW w AS (PARTITION BY c ORDER BY part, i), v AS (PARTITION BY c ORDER BY part, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
members AS (SELECT c, d, md5(k) AS k, md5(coalesce(up, '')) AS up, words FROM placed UNION ALL SELECT c, 0, md5(''), NULL, 0 FROM convs),
lengths AS (SELECT c, max(d) AS length FROM members GROUP BY c),
ended AS (SELECT k, string_agg(c, ',' ORDER BY c) AS ids FROM members JOIN lengths USING (c) WHERE d = length GROUP BY k),
nodes AS (SELECT k, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, any_value(words) AS words FROM members GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
below AS (SELECT DISTINCT a.k AS top, b.k FROM members a JOIN members b ON a.c = b.c AND b.d >= a.d),
sums AS (SELECT top AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * words) AS saved FROM below JOIN whole USING (k) GROUP BY top)
SELECT whole.conv_id, CAST(whole.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, whole.n AS n_convs, whole.n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM whole JOIN sums USING (k) LEFT JOIN nodes p ON p.k = whole.up LEFT JOIN ended ON ended.k = whole.k
"""
