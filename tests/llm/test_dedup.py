"""Exact, near and substring deduplication against plain Python, with the odd inputs."""

import random
from collections import defaultdict
from hashlib import sha256

from xxhash import xxh64_intdigest

from tempora.llm import exact_dedup, simhash, substring_dedup

SCHEMA = "doc_id long, text string, keep_id long, digest string, fp int, doc string, tk int"
EXTRA = (1, "x", 2, "y", 3)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], SCHEMA).repartition(3)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def odd_rows():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", " x", "Ab"]
    some = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 19, 20, 21, 60, 150]))) for _ in range(40)]
    passage = " ".join(f"p{i}" for i in range(55))
    rows = list(enumerate(some))
    rows += [(100 + i, f"{rnd.choice(some)}\n{passage}\t{i}") for i in range(12)]  # a passage that repeats
    rows += [(200 + i, some[6]) for i in range(30)]  # a large group of copies
    rows += [(300 + i, some[6] + f" t{i}") for i in range(6)]  # near copies
    rows += [(400, "la " * 90), (401, "la " * 25 + "end"), (402, None), (403, ""), (404, "  \n"), (None, some[3]), (None, passage)]
    rows += [(405, passage + " twice"), (405, passage + " twice"), (406, " ".join(f"v{i}" for i in range(5000)))]
    return rows


def test_exact_groups(spark):
    rows = odd_rows()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for limits in ({}, {"winners": 2, "tracked": 64, "share": 0.05}):
        out = got(exact_dedup.exact_groups(frame(spark, rows), **limits))
        kept = defaultdict(int)
        for doc_id, keep_id, size, stays, sha in out:
            kept[sha] += stays
        want = []
        for i, t in rows:
            ids = [x for x in groups[t or ""] if x is not None]
            want.append((i, max(ids, default=None), len(groups[t or ""]), sha256((t or "").encode()).hexdigest()))
        assert [(r[0], r[1], r[2], r[4]) for r in out] == sorted(want, key=repr)
        assert set(kept.values()) == {1}
        assert all(r[0] == r[1] for r in out if r[3])
        left = exact_dedup.drop_copies(frame(spark, rows), **limits)
        assert left.columns == frame(spark, rows).columns
        assert sorted((r["text"] or "") for r in left.collect()) == sorted(groups)
    assert exact_dedup.exact_groups(frame(spark, rows).limit(0)).count() == 0
    assert exact_dedup.drop_copies(frame(spark, rows).limit(0)).count() == 0


def plain_fingerprint(text, n=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance):
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [(d, f"{p:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def test_simhash(spark):
    rows = odd_rows()
    for distance in (4, 3, 0):
        assert got(simhash.near_groups(frame(spark, rows), distance=distance)) == sorted(plain_components(rows, distance), key=repr)
    want = {c for _, _, c in plain_components(rows, 4)}
    left = simhash.keep_one(frame(spark, rows))
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(ids, key=repr) == sorted(want, key=repr) and left.columns == frame(spark, rows).columns
    assert simhash.near_groups(frame(spark, rows).limit(0)).count() == 0
    assert simhash.keep_one(frame(spark, rows).limit(0)).count() == 0


def test_collisions_in_small_parts(monkeypatch):
    """Splitting by bits finds the same components as one part."""
    import numpy as np

    rnd = np.random.default_rng(1)
    centres = rnd.integers(0, 1 << 63, 20, dtype=np.uint64)
    points = np.unique(np.concatenate([c ^ (np.uint64(1) << rnd.integers(0, 64, 8, dtype=np.uint64)) for c in centres]))
    want = {(i, j) for i in range(len(points)) for j in range(i) if (int(points[i]) ^ int(points[j])).bit_count() <= 4}
    for part in (4_000_000, 5_000):
        monkeypatch.setattr(simhash, "PART", part)
        found = []
        simhash._collide(points, np.full(len(points), 2), 64, 0, found)
        parent = {int(p): int(p) for p in points}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for pairs in found:
            for a, b in zip(*pairs.tolist()):
                parent[find(a)] = find(b)
        assert all(find(int(points[i])) == find(int(points[j])) for i, j in want)


def plain_substring(rows, length=20):
    places = defaultdict(list)
    split = [words(t) for _, t in rows]
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    for r, w in enumerate(split):
        for s in range(len(w) - length + 1):
            places[tuple(w[s : s + length])].append((order[r], s))
    first = {k: min(v) for k, v in places.items()}
    out = []
    for r, w in enumerate(split):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (order[r], s):
                gone.update(range(s, s + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((rows[r][0], len(w), len(gone), sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def test_substring(spark, monkeypatch):
    rows = odd_rows()
    want = plain_substring(rows)
    assert sum(r[2] for r in want) > 0
    assert got(substring_dedup.dedup(frame(spark, rows)).drop("repeats")) == [r[:4] for r in want]
    whole = got(substring_dedup.dedup(frame(spark, rows), with_text=True).drop("repeats"))
    assert whole == want
    assert substring_dedup.dedup(frame(spark, rows).limit(0)).count() == 0
    other = [(i, t) for i, t in rows if i is not None and i < 120] + [(7, "another text " * 30)]  # two texts with one doc_id
    assert got(substring_dedup.dedup(frame(spark, other), length=6, gram=3).drop("repeats")) == [r[:4] for r in plain_substring(other, 6)]


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(400)).encode()
    whole = substring_dedup.Words(text)
    want = [x for _, least, _, _ in substring_dedup.seeds_by_window(whole) for x in least.tolist()]
    monkeypatch.setattr(substring_dedup, "BLOCK", 50)
    assert [x for _, least, _, _ in substring_dedup.seeds_by_window(whole) for x in least.tolist()] == want
    monkeypatch.setattr(simhash, "BLOCK", 50)
    assert simhash.fingerprint(text) == plain_fingerprint(text.decode())
