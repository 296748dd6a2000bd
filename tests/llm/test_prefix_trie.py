"""Prefix trie: the perfect hash, and the whole trie against plain Python and DuckDB."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tempora.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, words int, depth int"


def plain(rows):
    """Every node by its definition."""
    by, rebuilt, members = defaultdict(list), {}, defaultdict(set)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            by[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    for own in by.values():
        own.sort()
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        lender = by.get(c - int(math.fmod(c, 20)), [])
        rebuilt[c] = [x[2:] for x in lender[:h] + own[h:]]
    for c, own in rebuilt.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].add(c)
    children, saved, leaves = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += not children[k]
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    out = []
    for c in [*range(-45, 70), None]:
        if pick.random() < 0.15:
            continue
        for i in range(pick.choice([1, 1, 2, 3, 4, 6, 12])):
            turn = pick.choice([None, i, i, i, i, i // 2])
            out.append((c, turn, pick.choice([None, "u"]), pick.choice(["a", "a", "a b", "", None, "c d e"]), 1, 1))
    for c, n in ((200, 300), (210, 280), (219, 300)):  # long ones that share most of their turns
        out += [(c, i, "u", "x y" if i % 7 else "z", None, None) for i in range(n)]
    out += [(220, 0, "u", "same", 0, 0)] * 90  # one row, many times
    out += [(c, 0, "u", "hello", 0, 0) for c in range(1000, 1700)]  # a very common conversation
    return out


@pytest.mark.parametrize("per_shard", [50_000, 60, 7])
def test_trie_equals_plain_python(spark, rows, per_shard):
    """However few turns a shard holds: conversations then lie in many."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert Counter(map(tuple, prefix_trie.trie(df, per_shard=per_shard).collect())) == plain(rows)


def test_oracle_equals_plain_python(spark, rows):
    con = duckdb.connect()
    con.register("t", spark.createDataFrame(rows, SCHEMA).toArrow())
    assert Counter(con.execute(prefix_trie.ORACLE.format(conversations="t")).fetchall()) == plain(rows)


def test_empty_tables_and_ids(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(df).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "x", 1, 1)], SCHEMA)).count() == 0


def test_long_text(spark):
    rows = [(1, 0, "u", "wort " * 200_000, 0, 0), (2, 0, "u", " " * 500_000, 0, 0), (2, 1, None, None, 0, 0)]
    assert Counter(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_pieces_of_a_long_list_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(c, 0, "u", "hello", 0, 0) for c in range(40)]
    assert Counter(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), per_shard=11).collect())) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash(n):
    numbers = np.random.default_rng(n).integers(0, 1 << 63, (2 * n, 2)).astype(np.uint64)
    keys, others = numbers[:n], numbers[n:]
    known = prefix_trie.PerfectHash(keys)
    assert sorted(known.slots(keys)) == list(range(n))  # minimal and perfect
    assert (known.slots(others) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.zeros((2, 2), np.uint64))
