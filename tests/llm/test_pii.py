import random
import re
from collections import Counter
from hashlib import sha256

from tempora.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(len(x.lstrip("0")) <= 3 and int("0" + x.lstrip("0")) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and plain_luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    None, "", "a@b.c@d.e x@y z@w.v.u", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3", "card 4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111",
    "call +1 (436) 555-8670. or +12 345", "é+44 20 7946 0958é ñ.30@mail1.example.com é", "joe (at) example [dot] com", "tel (555) 123-4567 or 555-123-4567",
    "@" * 50 + "a.b" * 20, "9" * 5000, "0" * 5000 + ".1.1.1 and " + "0" * 4999 + "7." * 3 + "256", "a" * 20000 + "@x.y", "2001:0db8:85a3:0000:0000:8a2e:0370:7334 host", "-+.%@a-b.c-d", "1 2 3 4 5 6 7 8 9 0 1 2 3 4",
]


def test_strict_spans_equal_plain_patterns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(0, "dup a@b.cd", "x", 1), (0, "dup a@b.cd", "x", 1), (None, "1.1.1.1", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int")
    got = sorted(map(tuple, pii.detect(df).collect()), key=repr)
    want = []
    for i, text, *_ in rows:
        found = plain(text)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        want.append((i, *(sum(k == kind for k, _, _ in found) for kind in BASE), sha256(base.encode()).hexdigest(), found))
    for g, w in zip(got, sorted(want, key=repr), strict=True):
        assert g[:6] == w[:6]
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in g[6].split(",") if s)]
        assert set(w[6]) <= set(spans) and spans == sorted(spans, key=lambda s: (list(BASE).index(s[0]), s[1]))
    assert pii.detect(df.limit(0)).count() == 0


def test_reliable_labelers_decide():
    """Candidates that pass their check and stand near a cue are real, those that fail are not."""
    good, bad, extra, junk = map(pii.packed, [(2, 2, 2, 1, 2), (0, 0, 0, 1, 0), (1, 2, 1, 2, 2), (0, 0, 1, 1, 2)])
    real = pii.labels([(3, good, 900), (3, bad, 500), (3, extra, 60), (3, junk, 300)])
    assert real[3, good] > 0.9 and real[3, extra] > 0.9 and real[3, bad] < 0.1 and real[3, junk] < 0.1


def planted(n, seed):
    """Texts of prose with one thing in each: (text, kind or None, start, end)."""
    r = random.Random(seed)
    words = "the of lorem and ipsum on dolor sit amet was by elit then sed".split()

    def digits(k):
        return "".join(r.choice("0123456789") for _ in range(k))

    def prose():
        return " ".join(r.choice(words) for _ in range(r.randint(3, 20)))

    def card(valid):
        d = "4" + digits(14)
        return d + next(c for c in "0123456789" if plain_luhn(d + c) == valid)

    makers = [
        ("email", lambda: (r.choice(["contact", "mail", "write to"]), f"{r.choice(words)}.{digits(3)}{r.choice([' (at) ', ' [at] ', ' at '])}{r.choice(words)} dot {r.choice(['com', 'org', 'net'])}")),
        ("phone", lambda: (r.choice(["tel", "call", "phone:"]), r.choice([f"({r.randint(201, 989)}) 555-{digits(4)}", f"{r.randint(201, 989)}-555-{digits(4)}", f"020 7946 {digits(4)}", f"01 {digits(2)} {digits(2)} {digits(2)} {digits(2)}"]))),
        ("ip", lambda: (r.choice(["host", "server", "from address"]), r.choice([f"2001:db8::{digits(4)}", f"fe80::{digits(3)}:{digits(4)}", ":".join(["2001", "db8"] + [digits(4) for _ in range(6)])]))),
        ("secret", lambda: (r.choice(["token =", "api key:", "password ="]), "".join(r.choice("0123456789abcdef") for _ in range(40)))),
        (None, lambda: (r.choice(["the", "serial"]), card(False))),
        (None, lambda: ("version", f"{r.randint(1, 9)}.{r.randint(300, 999)}.{r.randint(1, 9)}.{r.randint(300, 999)}")),
        (None, lambda: ("at", f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}")),
        (None, lambda: ("look at", "the house dot")),
        (None, lambda: (r.choice(words), "antidisestablishmentarianism" + r.choice(words))),
        ("strict", lambda: ("card", card(True))),
        ("strict", lambda: ("call", f"+1 ({r.randint(201, 989)}) 555-{digits(4)}")),
        ("strict", lambda: ("mail", f"{r.choice(words)}{digits(2)}@{r.choice(words)}.com")),
        ("strict", lambda: ("host", ".".join(str(r.randint(1, 255)) for _ in range(4)))),
    ]
    for _ in range(n):
        kind, make = r.choice(makers)
        lead, thing = make()
        head = f"{prose()} {lead} "
        yield f"{head}{thing} {prose()}.", kind, len(head), len(head) + len(thing)


def test_recall_and_precision_of_added_spans(spark):
    rows = list(planted(1500, 3))
    out = pii.detect(spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(rows)], "doc_id long, text string").repartition(3)).collect()
    hits, wanted, given = Counter(), Counter(), Counter()
    for r in out:
        text, kind, start, end = rows[r["doc_id"]]
        both = [x for x in f"{r['spans']},{r['secrets']}".split(",") if x]
        added = set(both) - {f"{k}:{a}:{b}" for k, a, b in plain(text)}
        assert len(added) == r["n_added"] + r["n_secret"] and len(both) == r["n_spans"]
        given.update(x.split(":")[0] for x in added)
        if kind not in (None, "strict"):
            wanted[kind] += 1
            hits[kind] += f"{kind}:{start}:{end}" in added
    print(hits, wanted, given)
    for kind in ("email", "phone", "ip", "secret"):
        assert hits[kind] >= 0.9 * wanted[kind] and hits[kind] >= 0.9 * given[kind], (kind, hits, wanted, given)
    assert not given["card"]


def test_the_classifier_reads_span_and_context():
    """Equal votes, told apart by the words beside the span."""
    own = (1, 2, 1, 1, 2)
    real = "ring me on 555-123-4567 please"
    other = "batch of 555-123-4567 widgets"
    fs = [pii.features(t, 3, t.index("555"), t.index("4567") + 4, own) for t in (real, other)]
    w = pii.fit([(fs[0], 0.95)] * 20 + [(fs[1], 0.05)] * 20)
    assert sum(w[fs[0]]) > 1 and sum(w[fs[1]]) < -1


def test_added_spans_never_overlap(spark):
    text = "tel (555) 123-4567 +1 (436) 555-8670 020 7946 0958 a (at) b.com c at d dot com " * 300
    found = pii.spans(text)
    for kind in range(len(pii.KINDS)):
        own = [(a, b) for k, a, b, *_ in found if k == kind]
        assert own == sorted(own) and all(b <= c for (_, b), (c, _) in zip(own, own[1:]))
    sure = [(a, b) for _, a, b, s, *_ in found if s]
    assert all(b <= x or a >= y for _, a, b, s, *_ in found[:40] if not s for x, y in sure)
