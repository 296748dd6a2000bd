"""Writing WARC archives, and reading them back in byte ranges by boundary chains.

Writing. One record per page: a ``response``, or a ``revisit`` that refers to
the page with the smallest page_id among those with an equal payload of at
least ``LEAST`` bytes. Only the digests of repeated payloads are joined to the
pages. Spark's text writer writes the records; a record's closing blank lines
are its line separator.

Reading. A file is read in splits, line by line (CRLF), so that a large file
is the work of many tasks:

1. A task finds candidate records in its split: a version line and the header
   up to a blank line. The header's length field gives the candidate's
   successor. Candidates whose successor lies in the split are joined to runs:
   what remains for each is the offset where its chain leaves the split.
2. From the start of each file, pointer jumping over these offsets (each round
   doubles the reach of every pointer) finds where the true chain enters each
   split. A version line inside a payload is a candidate too, but nothing that
   is reached from the start of the file leads to it.
3. Each split is read again with its entry (three numbers for each split, which
   are broadcast) and its part of the true chain is followed. Records within
   the split are complete; only those that cross a boundary are shuffled.

If the chain of a file does not end where the file does, reading fails: no
record is left out in silence.

Defined results: a null html is an empty payload, a null url an empty one;
line breaks in a url are removed. A null page_id counts as the largest; if all
pages of a group have none, all are responses. Rows that repeat the smallest
page_id of their group are responses too. A header must fit in two adjacent
splits and ``HEADER`` bytes. An empty table gives no records. Further columns
play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers, text_of
from tempora.session import scratch_path

LEAST = 100  # bytes from which equal payloads are revisits
DATE = "2024-01-01T00:00:00Z"
HEADER = 1 << 16
BREAK = "\r\n"
SPLITS = 8_000_000  # splits whose entries may be broadcast: 24 bytes each

_MAGIC = re.compile(rb"WARC/1\.[01]")
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$")


def write(pages: DataFrame, path: str | None = None, date: str = DATE, least: int = LEAST) -> str:
    """Write a record for each row of ``pages`` (page_id, url, html) to files in
    ``path``, by default a new folder in the shared one. Returns the path."""
    path = path or scratch_path(pages.sparkSession, "llm-warc")
    html = text_of("html")
    size, sha = F.octet_length(html), F.sha2(html.cast("binary"), 256)
    long_ones = pages.select("page_id", size.alias("size"), sha.alias("sha")).where(F.col("size") >= least)
    groups = long_ones.groupBy("sha").agg(F.min("page_id").alias("original"), F.max("page_id").alias("last"), F.count("page_id").alias("n"), F.count(F.lit(1)).alias("rows"))
    groups = cut(groups.where("rows > 1 and n > 0 and (original < last or n < rows)").select("sha", "original"), "originals")
    rows = pages.select("page_id", "url", html.alias("html"), size.alias("size"), sha.alias("sha")).join(groups, "sha", "left")
    revisit = F.col("original").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("original")))

    def page(col: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(col).cast("string"), F.lit("")), F.lit(">"))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("size").cast("string"), F.lit(BREAK + BREAK))
    rows = rows.withColumn("revisit", revisit).withColumn("block", F.when(F.col("revisit"), http).otherwise(F.concat(http, "html")))
    record = F.concat(
        F.lit(f"WARC/1.1{BREAK}WARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit(f"{BREAK}WARC-Record-ID: "),
        page("page_id"),
        F.lit(f"{BREAK}WARC-Date: {date}{BREAK}WARC-Target-URI: "),
        F.regexp_replace(text_of("url"), "[\r\n]", ""),
        F.lit(f"{BREAK}WARC-Payload-Digest: sha256:"),
        F.col("sha"),
        F.when(
            F.col("revisit"),
            F.concat(F.lit(f"{BREAK}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{BREAK}WARC-Refers-To: "), page("original")),
        ).otherwise(""),
        F.lit(f"{BREAK}Content-Type: application/http;msgtype=response{BREAK}Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(BREAK + BREAK),
        F.col("block"),
    )
    rows.select(record.alias("value")).write.option("lineSep", BREAK + BREAK).text(path)
    return path


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file (a hash of its name), block (where the split starts) and the bytes of each line, in order."""
    lines = spark.read.option("lineSep", BREAK).text(path)
    return on_workers(lines).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


class _Split:
    """What a task learns from one split: its size, its head (the lines up to
    the first blank one) and its candidates. Offsets count from its first line."""

    def __init__(self, file: int, block: int):
        self.file, self.block, self.at = file, block, 0
        self.head: list[bytes] = []
        self.head_size = 0
        self.head_end = -1  # after the blank line; -1: none yet
        self.open: list[int] = []  # candidates whose header has not ended
        self.zone: list[tuple[int, bytes]] = []  # their lines
        self.found: list[tuple[int, int, int]] = []  # offset, payload start, payload length

    def line(self, line: bytes) -> None:
        if self.head_end < 0 and self.head_size <= HEADER:
            if line:
                self.head.append(line)
                self.head_size += len(line)
            else:
                self.head_end = self.at + 2
        if self.open and not line:
            lengths = [(at, m[1]) for at, x in self.zone if (m := _LENGTH.search(x + b"\r\n"))]
            for start in reversed(self.open):  # the first length after each
                while len(lengths) > 1 and lengths[-2][0] >= start:
                    lengths.pop()
                if lengths and lengths[-1][0] >= start:
                    self.found.append((start, self.at + 2, int(lengths[-1][1])))
            self.open, self.zone = [], []
        if _MAGIC.fullmatch(line):
            self.open.append(self.at)
        if self.open:
            self.zone.append((self.at, line))
            if self.at - self.zone[0][0] > HEADER:
                self.open, self.zone = [], []
        self.at += len(line) + 2

    def rows(self) -> Iterator[dict]:
        where = {"file": self.file, "block": self.block}
        yield where | {"kind": "split", "a": self.at, "b": self.head_end, "text": b"\r\n".join(self.head)}
        after: dict[int, tuple[int, tuple[int, int, int]]] = {}  # of each candidate: the end of its chain here, the last record
        for start, payload, length in sorted(self.found, reverse=True):
            next_one = payload + length + 4
            after[start] = after.get(next_one, (next_one, (start, payload, length)))
        for start, (end, last) in after.items():
            yield where | {"kind": "candidate", "a": start, "b": end, "c": last[0], "d": last[1], "e": last[2]}
        for start in self.open:
            yield where | {"kind": "open", "a": start, "text": b"\r\n".join(x for at, x in self.zone if at >= start)}


_INDEX = [("file", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), *((c, pa.int64()) for c in "abcde"), ("text", pa.binary())]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split: _Split | None = None

    def told(s: _Split) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(list(s.rows()), pa.schema(_INDEX))

    for batch in batches:
        for file, block, line in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("line")):
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    yield told(split)
                split = _Split(file, block)
            split.line(line.as_py())
    if split is not None:
        yield told(split)


def _jump(nodes: DataFrame) -> DataFrame:
    """The nodes (file, off, jump) that are reached from offset 0 of their file."""
    reached, jumps = nodes.where("off = 0").select("file", "off"), nodes
    while True:
        reached, jumps = cut(reached, "reached"), cut(jumps, "jumps")
        onward = reached.join(jumps, ["file", "off"]).select("file", F.col("jump").alias("off"))
        new = onward.join(nodes.select("file", "off"), ["file", "off"], "left_semi").join(reached, ["file", "off"], "left_anti").distinct()
        new = cut(new, "new")
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        far = jumps.select("file", F.col("off").alias("jump"), F.col("jump").alias("beyond"))
        jumps = jumps.join(far, ["file", "jump"]).select("file", "off", F.col("beyond").alias("jump"))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """For each split: base (offset of its first line), entry (of the first
    record that starts in it, null if none does) and the record that covers its
    beginning: o_off, o_start, o_length, and o_header if its header isn't in one split."""
    found = cut(_lines(spark, path).mapInArrow(_index, "file long, block long, kind string, a long, b long, c long, d long, e long, text binary"), "candidates")
    along = Window.partitionBy("file").orderBy("block")
    splits = found.where("kind = 'split'").select(
        "file", "block",
        (F.sum("a").over(along) - F.col("a")).alias("base"), F.sum("a").over(along).alias("next"),
        F.lead("b").over(along).alias("next_head_end"), F.lead("text").over(along).alias("next_head"),
    )
    splits = cut(splits, "splits")
    base = splits.select("file", "block", "base")
    whole = found.where("kind = 'candidate'").join(base, ["file", "block"])
    whole = whole.select("file", "block", (F.col("a") + F.col("base")).alias("off"), (F.col("b") + F.col("base")).alias("jump"), (F.col("c") + F.col("base")).alias("o_off"), (F.col("d") + F.col("base")).alias("o_start"), F.col("e").alias("o_length"), F.lit(None).cast("binary").alias("o_header"))
    broken = found.where("kind = 'open'").select("file", "block", "a", "text").join(splits, ["file", "block"]).where("next_head_end >= 0")
    header = F.when(F.octet_length("next_head") > 0, F.concat("text", F.lit(b"\r\n"), "next_head")).otherwise(F.col("text"))
    length = F.regexp_extract(F.decode(header, "ISO-8859-1"), r"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", 1)
    broken = broken.where(length != "").select("file", "block", (F.col("a") + F.col("base")).alias("off"), (F.col("next") + F.col("next_head_end")).alias("o_start"), length.cast("long").alias("o_length"), header.alias("o_header"))
    broken = broken.select("file", "block", "off", (F.col("o_start") + F.col("o_length") + 4).alias("jump"), F.col("off").alias("o_off"), "o_start", "o_length", "o_header")
    nodes = cut(whole.unionByName(broken), "nodes")
    # only what another candidate leads to, or a file's start, can be an entry
    targets = nodes.select("file", F.col("jump").alias("off")).distinct()
    linked = nodes.select("file", "off", "jump").join(targets, ["file", "off"], "left_semi").unionByName(nodes.where("off = 0").select("file", "off", "jump"))
    reached = nodes.join(_jump(linked.distinct()), ["file", "off"], "left_semi")
    own = reached.groupBy("file", "block").agg(F.min("off").alias("entry"), F.max_by(F.struct("o_off", "o_start", "o_length", "o_header"), "off").alias("owner"), F.max("jump").alias("end"))
    own = cut(own, "reached")
    sizes = splits.groupBy("file").agg(F.max("next").alias("size"))
    ends = own.groupBy("file").agg(F.max("end").alias("end"))
    torn = sizes.join(ends, "file", "left").where("size > 0 and (end is null or end <> size)").count()
    if torn:
        raise ValueError(f"{torn} archive files whose chain of records does not end where the file does")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    told = splits.select("file", "block", "base").join(own, ["file", "block"], "left")
    told = told.withColumn("owner", F.last("owner", ignorenulls=True).over(before))
    return cut(told.select("file", "block", "base", "entry", "owner.*"), "entries")


class _Chain:
    """Follows the true chain through one split."""

    def __init__(self, base: int, entry: int | None, owner: tuple | None):
        self.at, self.due = base, entry
        self.header: list[bytes] = []
        self.record: list | None = None  # offset, header, payload start, length, first byte held, bytes
        if owner and owner[1] + owner[2] > base:
            off, start, length, header = owner
            self.record = [off, header, start, length, max(start, base), []]

    def line(self, line: bytes) -> tuple | None:
        """The record that this line completes, if it does."""
        at, done = self.at, None
        self.at += len(line) + 2
        if self.record:
            if at >= self.record[2]:
                end = self.record[2] + self.record[3]
                self.record[5].append(line if at + len(line) >= end else line + b"\r\n")
                if at + len(line) >= end:
                    done, self.due = self.piece(), end + 4
                    self.record = None
        elif self.header:
            if line:
                self.header.append(line)
            else:
                header = b"\r\n".join(self.header)
                self.record, self.header = [self.due, header, at + 2, int(_LENGTH.search(header)[1]), at + 2, []], []
                if not self.record[3]:
                    done, self.due = self.piece(), at + 6
                    self.record = None
        elif at == self.due:
            self.header = [line]
        return done

    def piece(self) -> tuple:
        off, header, start, length, first, held = self.record
        return off, header, length, first - start, b"".join(held)


def parse(header: bytes, block: bytes) -> dict:
    """The fields of a record; digest and size of its payload, which a revisit only declares."""
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in header.decode("utf-8", "replace").split("\r\n")[1:])}
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type", "")
    if kind == "revisit":
        declared = _LENGTH.search(http)
        digest, size = fields.get("warc-payload-digest", "").removeprefix("sha256:"), int(declared[1]) if declared else 0
    else:
        digest, size = sha256(payload).hexdigest(), len(payload)

    def page(name: str) -> int | None:
        number = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if re.fullmatch(r"-?[0-9]+", number) else None

    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri", ""), "record_type": kind, "refers_to": page("warc-refers-to"), "payload_bytes": size, "payload_digest": digest, "payload": payload}


_PARSED = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
_PIECE = [("file", pa.int64()), ("off", pa.int64()), ("header", pa.binary()), ("length", pa.int64()), ("first", pa.int64()), ("bytes", pa.binary())]
_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and, if asked for, payload (empty for a revisit)."""
    told = entries(spark, path)
    if told.count() > SPLITS:
        raise ValueError("more splits than entries may be broadcast: raise spark.sql.files.maxPartitionBytes")
    lines = _lines(spark, path).join(F.broadcast(told), ["file", "block"])  # 24 bytes for each split, see SPLITS

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, key, out, size = None, None, [], 0

        def add(piece: tuple) -> None:
            nonlocal size
            off, header, length, first, held = piece
            if header is not None and first == 0 and len(held) == length:
                out.append(parse(header, held) | {} if with_payload else parse(header, held) | {"payload": None})
            else:
                out.append(dict(zip((n for n, _ in _PIECE), (key[0], off, header, length, first, held))))
            size += len(held)

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            batch = pa.RecordBatch.from_pylist(out, pa.schema(_PARSED + _PIECE))
            out, size = [], 0
            return batch

        for batch in batches:
            where = zip(batch.column("file").to_pylist(), batch.column("block").to_pylist())
            for i, (here, line) in enumerate(zip(where, batch.column("line"))):
                if here != key:
                    if chain is not None and chain.record:
                        add(chain.piece())
                    row = {c: batch.column(c)[i].as_py() for c in ("base", "entry", "o_off", "o_start", "o_length", "o_header")}
                    owner = None if row["o_off"] is None else (row["o_off"], row["o_start"], row["o_length"], row["o_header"])
                    key, chain = here, _Chain(row["base"], row["entry"], owner)
                if piece := chain.line(line.as_py()):
                    add(piece)
                if size > 4 << 20:
                    yield flush()
        if chain is not None and chain.record:
            add(chain.piece())
        yield flush()

    followed = lines.mapInArrow(follow, f"{_SCHEMA}, file long, off long, header binary, length long, first long, bytes binary")
    if not with_payload:
        followed = cut(followed, "records")  # without the payloads, but for the pieces of records that cross a boundary

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse(h, b) | ({} if with_payload else {"payload": None}) for h, b in zip(batch.column("header").to_pylist(), batch.column("bytes").to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(_PARSED))

    pieces = followed.where("off is not null").groupBy("file", "off").agg(F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("first", "bytes"))).alias("p"))
    crossing = pieces.select("header", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["bytes"])).alias("bytes")).mapInArrow(join, _SCHEMA)
    names = [n for n, _ in _PARSED if with_payload or n != "payload"]
    return followed.where("off is null").select(*names).unionByName(crossing.select(*names))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of ``pages`` and read them: page_id, payload_bytes,
    payload_digest, record_type, refers_to of each record."""
    return read(pages.sparkSession, write(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS sha FROM {{pages}}),
g AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS original FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha AS payload_digest,
       CASE WHEN n >= {LEAST} AND page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST} AND page_id > original THEN original END AS refers_to
FROM g
"""
