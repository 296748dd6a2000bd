import random
from hashlib import sha256

import pytest

from tempora.llm import warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 7\r\n\r\npayload\r\n\r\n"
SCHEMA = "page_id long, url string, html string, sha string, original long"


def hostile(n):
    rnd = random.Random(5)
    parts = [FAKE, "\r\n", "\r\n\r\n", "\n", "\r", "WARC/1.0\r\n", "WARC/1.1\r\nContent-Length: 5\r\n", "<p>é</p>", "x" * 300, "word " * 40]
    rows = []
    for i in range(n):
        html = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        rows.append((i * 7 % n, f"http://h/{i}\r\nx", html, "own", 1))
    rows += [(n + i, "u", rows[i][2], "own", 2) for i in range(0, n, 3)]
    rows += [(n * 2, None, None, None, None), (n * 2 + 1, "u", "", None, None), (None, "u", rows[0][2], None, None), (n * 2 + 2, "u", "y" * 40_000, None, None)]
    return rows


def brute(rows):
    first = {}
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        if page is not None:
            first[b] = min(first.get(b, page), page)
    out = []
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        revisit = len(b) >= 100 and b in first and (page is None or page > first[b])
        out.append((page, len(b), sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", [6_001])
def test_round_trip_over_splits(spark, small_splits, split):
    """Payloads with line breaks, fake records and records longer than a split."""
    rows = hostile(40)
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    path = warc.write(pages)
    small_splits(split)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert got(warc.read(spark, path).select(*names)) == brute(rows)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read(spark, path, with_payload=True).collect() if r["record_type"] == "response"}
    assert all(payloads[p] == (h or "").encode() for p, _, h, *_ in rows if p in payloads and p is not None)


def test_nulls_ties_repeats_and_empty_table(spark):
    rows = [(None, None, "z" * 200, "a", 0), (None, None, "z" * 200, "a", 0), (3, "u", "q" * 150, "a", 0), (3, "u", "q" * 150, "a", 0), (4, "u", "q" * 150, "a", 0), (5, "u", "short", "a", 0), (6, "u", "short", "a", 0)]
    assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_torn_archive_fails(spark, tmp_path):
    path = tmp_path / "torn"
    path.mkdir()
    (path / "a.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 500\r\n\r\nshort\r\n\r\n")
    with pytest.raises(ValueError, match="chain"):
        warc.read(spark, str(path)).count()


def test_many_magic_lines_in_one_header_zone():
    """Each candidate takes the first length after it, in time that grows with the lines."""
    split = warc._Split(1, 0)
    lines = [b"WARC/1.0", b"Content-Length: 7", b"WARC/1.0", b"WARC/1.0", b"content-length: 9", b"Content-Length: 3", b"WARC/1.0", b""]
    at, starts = 0, []
    for x in lines:
        if x == b"WARC/1.0":
            starts.append(at)
        split.line(x)
        at += len(x) + 2
    assert sorted(split.found) == [(starts[0], at, 7), (starts[1], at, 9), (starts[2], at, 9)]
    split = warc._Split(1, 0)
    for x in [b"WARC/1.0"] * 6000 + [b"Content-Length: 5", b""]:
        split.line(x)
    assert len(split.found) == 6000 and {n for _, _, n in split.found} == {5}
