"""Personal data by weak supervision.

Labelers look at every candidate span and vote for, against or not at all:

- regex: for what the strict pattern of the kind takes, against what has its
  form but fails its check; no vote on forms that the pattern doesn't know;
- check: octets, Luhn sum, number of digits, valid addresses, mixed characters;
- gazetteer: known top-level domains, calling codes, card prefixes, network and key prefixes;
- context: a word such as "tel" or "card" just before it, or one such as "order" or "serial";
- edges: does it stand alone, or is it part of a longer token.

Candidates are the matches of the strict patterns and of looser ones: numbers
that fail their check, written-out addresses, national phone forms, IPv6 with
its short forms, and ``secret``, credentials such as keys and tokens, a kind
without a strict pattern. One pass over the texts finds them, their votes and
hashed features of the span (shape, length, separators) and its context (words
and characters on both sides). How often each combination of votes occurs is
counted over all documents: a table whose size is bounded by the number of
combinations. On it, expectation-maximisation estimates the reliability of each
labeler for each kind. The probabilities it gives are the labels of a logistic
classifier of spans, trained on some ``SAMPLE`` different candidates of each
combination. A candidate that the classifier accepts is added to the spans of
the strict patterns, which always stay.

Defined results: a null text is empty and has no spans. Positions count code
points; bytes that aren't UTF-8 count one for each replacement character.
Matches are leftmost and do not overlap within a kind; one that fails its check
is dropped and not tried again. An added span never overlaps a strict one, nor
another of its kind. Null doc_ids and repeated rows are ordinary rows; equal
candidates count as one form in the sample. An empty table gives an empty
result. Further columns play no part.
"""

from __future__ import annotations

import ipaddress
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import cut, on_workers

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4  # kinds with a strict pattern
LABELERS = ("regex", "check", "gazetteer", "context", "edges")
ACCEPT = 0.8  # probability from which a candidate is added
LOOK = 24  # characters before a span in which a cue is looked for
ROUNDS = 60
SAMPLE = 300  # forms of each combination of votes that the classifier is trained on, as many as are expected
PLACES = 1 << 12  # of hashed features
STEPS = 400

# The strict patterns. A strict email starts where its run of local characters starts: it is found from its @.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The looser ones
AT = re.compile(r"[\[({]at[\])}] ?|(?<=[A-Za-z0-9]) at ")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?\Z")
HOST = re.compile(r"[A-Za-z0-9-]{1,63}((?: ?[\[({]dot[\])}] ?|\.| dot )[A-Za-z0-9-]{1,63}){1,8}")
IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
NATIONAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])|(?<![0-9+])0[0-9](?:[\x20.-]?[0-9]){7,13}(?![0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,512}(?![A-Za-z0-9_-])")
HEX = re.compile(r"(?i)(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})\Z")

# Gazetteers and cue words
TLDS = frozenset("com org net edu gov io de fr es uk us eu it nl info biz".split())
CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "7", "81", "86", "91")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38", "22", "23", "24", "25", "26", "27")
NETWORKS = ("2001:", "2a", "26", "24", "fe80:", "fc", "fd")
KEYS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "glpat-", "AIza", "eyJ")
NO_CUE = re.compile(r"(?i)\b(?:order|serial|part|isbn|version|build|invoice|sku|ticket|item|page|commit|checksum|digest|md5|sha1|sha256|revision)\b")
CUES = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|addr|from|adresse)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|payment|tarjeta|carte|karte)\b"),
    "secret": re.compile(r"(?i)(?:\b|_)(?:key|token|secret|passwd|password|pwd|api|auth|bearer|credentials?)\b"),
    "phone": re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|cell|tél|teléfono|telefon)\b"),
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def strict(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, in order."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if _octets(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def _address6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def loose(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of candidates beyond the strict ones, those of a kind in order of start."""
    for m in AT.finditer(text):
        left, right = LOCAL.search(text[max(0, m.start() - 65) : m.start()]), HOST.match(text, m.end())
        if left and right and (m[0] != " at " or " dot " in right[0]):
            yield 0, m.start() - len(left[0]), right.end()
    for m in IP.finditer(text):
        if not _octets(m[0]):
            yield 1, m.start(), m.end()
    if "::" in text or text.count(":") >= 7:
        for m in IP6.finditer(text):
            if len(re.findall("[0-9A-Fa-f]+", m[0])) > 1 and ("::" in m[0] or m[0].count(":") == 7):
                yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and not luhn(d):
            yield 2, m.start(), m.end()
    for m in NATIONAL.finditer(text):
        yield 3, m.start(), m.end()
    for m in SECRET.finditer(text):
        if any("0" <= c <= "9" for c in m[0]) and any(c.isalpha() for c in m[0]):
            yield 4, m.start(), m.end()


def votes(text: str, kind: int, start: int, end: int, is_strict: bool) -> tuple[int, ...]:
    """The labelers' votes: 0 against, 1 none, 2 for."""
    span = text[start:end]
    digits = _digits(span)
    regex, check, known = 2 if is_strict else 1, 1, 1
    if kind == 0:
        check = 2 if 1 <= sum(c.isalnum() for c in span[:64]) and not span.startswith((".", "-", "%")) else 0
        known = 2 if re.split(r"[.\])}\x20]+", span)[-1].lower() in TLDS else 1
    elif kind == 1 and ":" in span:
        check = 2 if _address6(span) else 0
        known = 2 if span.lower().startswith(NETWORKS) else 1
    elif kind == 1:
        check = 2 if _octets(span) else 0
        known = 0 if span.startswith(("0.", "255.")) else 2 if span.startswith(("10.", "192.168.", "172.", "127.")) else 1
    elif kind == 2:
        check = 2 if luhn(digits) else 0
        known = 2 if digits.startswith(CARD_PREFIXES) else 0
    elif kind == 3:
        check = 2 if 9 <= len(digits) <= 15 else 0
        known = (2 if digits.startswith(CALLING) else 0) if span.startswith("+") else 1
    else:
        regex = 2 if HEX.match(span) or span.startswith(KEYS) else 1
        check = 2 if len(digits) >= 4 and len(set(span)) >= 10 else 0
        known = 2 if span.startswith(KEYS) else 1
    if not is_strict and check == 0:
        regex = 0
    low = max(0, start - LOOK)
    cue = 2 if CUES[KINDS[kind]].search(text, low, start) else 0 if NO_CUE.search(text, low, start) else 1
    before, after = text[start - 1 : start], text[end : end + 1]
    more = text[end + 1 : end + 2]
    inside = before.isalnum() or after.isalnum() or (before in ".-_" and before != "") or (after in ".-_" and after != "" and more.isalnum())
    return regex, check, known, cue, 0 if inside else 2


def packed(own: tuple[int, ...]) -> int:
    """The votes as one number, a digit to the base three each."""
    out = 0
    for vote in own:
        out = 3 * out + vote
    return out


def features(text: str, kind: int, start: int, end: int, own: tuple[int, ...]) -> list[int]:
    """Places of the features of a span, its context and its votes."""
    ends = text[start : min(end, start + 32)] + text[max(start + 32, end - 32) : end]
    shape = re.sub(r"([9aA])\1+", r"\1", re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", ends))))
    before, after = text[max(0, start - LOOK) : start], text[end : end + LOOK]
    left, right = re.findall(r"\w+", before.lower()), re.findall(r"\w+", after.lower())
    named = [f"v{i}{vote}" for i, vote in enumerate(own)]
    named += ["bias", f"s{shape[:16]}", f"n{min(end - start, 80) // 4}", f"d{min(len(_digits(ends)), 20)}", f"b{before[-1:]}", f"a{after[:1]}"]
    named += [f"l{w}" for w in left[-2:]] + [f"r{w}" for w in right[:1]]
    return [zlib.crc32(f"{KINDS[kind]} {x}".encode("utf-8", "replace")) % PLACES for x in named]


def spans(text: str) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(kind, start, end, strict, votes, features) by kind, then start."""
    sure = strict(text)
    starts: list[int] = []  # of the strict spans' union, and its ends
    ends: list[int] = []
    for _, a, b in sorted(sure, key=lambda x: x[1]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    every = [(k, a, b, True) for k, a, b in sure]
    last = (-1, 0)
    for k, a, b in sorted(loose(text)):
        i = bisect_right(starts, b - 1)  # the union's intervals that start before the span ends
        if (not i or ends[i - 1] <= a) and (k != last[0] or a >= last[1]):
            every.append((k, a, b, False))
            last = (k, b)
    out = []
    for k, a, b, is_strict in sorted(every):
        own = votes(text, k, a, b, is_strict)
        out.append((k, a, b, is_strict, packed(own), features(text, k, a, b, own)))
    return out


SPAN = "array<struct<kind: int, first: long, last: long, strict: boolean, votes: int, features: array<int>>>"


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the candidates of each row of ``docs``, with their votes and features."""
    narrow = on_workers(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    fields = [("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("strict", pa.bool_()), ("votes", pa.int32()), ("features", pa.list_(pa.int32()))]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                own = spans((text.as_py() or b"").decode("utf-8", "replace"))
                found.append([dict(zip((name for name, _ in fields), s)) for s in own])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.struct(fields)))], ["doc_id", "spans"])

    return narrow.mapInArrow(each, f"doc_id {kind}, spans {SPAN}")


def _unpack(pattern: np.ndarray) -> np.ndarray:
    """Votes by labeler."""
    return np.stack([pattern // 3**i % 3 for i in reversed(range(len(LABELERS)))], axis=1)


def reliabilities(v: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over the combinations of votes ``v`` and their
    counts: the probability that a span of each is real, and for each labeler
    and class (real or not) the probabilities of its votes. Some made-up votes
    that agree with the class keep the classes from trading places."""
    n = v.shape[1]
    real = 1 / (1 + np.exp(-(v - 1.0).sum(axis=1)))
    agree = np.zeros((n, 2, 3))
    agree[:, 1] = (1, 2, 4)
    agree[:, 0] = (4, 2, 1)
    theta = agree
    for _ in range(ROUNDS):
        by_class = np.stack([(1 - real) * count, real * count])
        theta = agree.copy()
        for labeler in range(n):
            for vote in range(3):
                theta[labeler, :, vote] += by_class[:, v[:, labeler] == vote].sum(axis=1)
        theta /= theta.sum(axis=2, keepdims=True)
        prior = (by_class.sum(axis=1) + 1) / (count.sum() + 2)
        log = np.log(prior) + sum(np.log(theta[k][:, v[:, k]]).T for k in range(n))
        real = 1 / (1 + np.exp((log[:, 0] - log[:, 1]).clip(-50, 50)))
    return real, theta


def labels(combinations: list[tuple[int, int, int]]) -> dict[tuple[int, int], float]:
    """``combinations``: (kind, votes, count). The probability that a candidate of each is real."""
    out = {}
    for kind in sorted({k for k, _, _ in combinations}):
        own = sorted((v, n) for k, v, n in combinations if k == kind)
        real, _ = reliabilities(_unpack(np.array([v for v, _ in own])), np.array([n for _, n in own], float))
        out |= {(kind, v): float(p) for (v, _), p in zip(own, real)}
    return out


def fit(rows: list[tuple[list[int], float]]) -> np.ndarray:
    """Weights of a logistic classifier. ``rows``: places of features and the probability of being real."""
    w = np.zeros(PLACES)
    if not rows:
        return w
    sizes = np.array([len(f) for f, _ in rows])
    place, owner = np.concatenate([f for f, _ in rows]).astype(np.int64), np.repeat(np.arange(len(rows)), sizes)
    real, square = np.array([p for _, p in rows]), np.full(PLACES, 1e-6)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.bincount(owner, w[place], len(rows))))
        g = np.bincount(place, ((p - real) / len(rows))[owner], PLACES) + 1e-5 * w
        square += g * g
        w -= 0.2 * g / np.sqrt(square)
    return w


def train(found: DataFrame) -> np.ndarray:
    """The classifier's weights, from the candidates of ``find``."""
    each = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.features").agg(F.count(F.lit(1)).alias("n"))
    each = cut(each, "candidates")
    sums = each.groupBy("kind", "votes").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms")).collect()  # at most 5 * 3^5 rows
    if not sums:
        return np.zeros(PLACES)
    real = labels([(r["kind"], r["votes"], r["n"]) for r in sums])
    limits = [(r["kind"], r["votes"], min((1 << 63) - 1, (1 << 63) * SAMPLE // r["forms"])) for r in sums]
    limits = each.sparkSession.createDataFrame(limits, "kind int, votes int, most long")
    u = F.shiftrightunsigned(F.xxhash64("kind", "votes", "features"), 1)
    chosen = each.join(F.broadcast(limits), ["kind", "votes"]).where(u <= F.col("most")).select("kind", "votes", "features").collect()
    return fit(sorted((r["features"], real[r["kind"], r["votes"]]) for r in chosen))


def accept(found: DataFrame, weights: np.ndarray) -> DataFrame:
    """``found`` without the candidates that are neither strict nor accepted."""
    fields = [("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("strict", pa.bool_())]
    kind = found.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            own = lists.flatten()
            places = own.field("features")
            owner = np.repeat(np.arange(len(own)), pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64))
            score = np.bincount(owner, weights[places.flatten().to_numpy(zero_copy_only=False)], len(own))
            stays = own.field("strict").to_numpy(zero_copy_only=False).astype(bool) | (score >= np.log(ACCEPT / (1 - ACCEPT)))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes), stays, len(sizes)))]).astype(np.int32)
            parts = [own.field(name).filter(pa.array(stays)) for name, _ in fields]
            kept = pa.StructArray.from_arrays(parts, fields=[pa.field(*f) for f in fields])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), kept)], ["doc_id", "spans"])

    return found.mapInArrow(each, f"doc_id {kind}, spans array<struct<kind: int, first: long, last: long, strict: boolean>>")


def _joined(which: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    as_text = F.transform(which, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"].cast("string"), s["last"].cast("string")))
    return F.array_join(as_text, ",")


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the numbers of strict spans by kind,
    base_sha256 (of the strict spans) and spans (strict and added ones of these
    kinds), then n_added, n_secret and secrets (credentials, all of them added),
    and n_spans, the number of spans of all kinds."""
    found = cut(find(docs), "spans")
    every = accept(found, train(found))
    named = F.filter("spans", lambda s: s["kind"] < BASE)
    secret = F.filter("spans", lambda s: s["kind"] >= BASE)
    base = F.filter("spans", lambda s: s["strict"])

    def number(which: Column) -> Column:
        return F.size(which).cast("long")

    def strict_ones(kind: int) -> Column:
        return number(F.filter("spans", lambda s: s["strict"] & (s["kind"] == kind))).alias(f"n_{KINDS[kind]}")

    digest = F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256")
    added = number(F.filter("spans", lambda s: ~s["strict"] & (s["kind"] < BASE))).alias("n_added")
    more = [added, number(secret).alias("n_secret"), _joined(secret).alias("secrets"), number(F.col("spans")).alias("n_spans")]
    return every.select("doc_id", *map(strict_ones, range(BASE)), digest, _joined(named).alias("spans"), *more)
