"""Toxicity: features, ratios and regression against plain Python, and planted words held out."""

import math
import random
import zlib

import numpy as np
import pytest

from tempora.llm import toxicity

DOCS = "doc_id long, text string, toxic int, score double"
LABELS = "doc_id long, quality int, toxic int"


def fold(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 4


def grams(text):
    text = (text or "").lower()
    return {text[i : i + n] for n in toxicity.NGRAMS for i in range(len(text) - n + 1)}


def test_features_are_the_distinct_ngrams_of_the_whole_text(monkeypatch):
    features = toxicity.Features()
    for text in ("", None, "ab", "abc", "Ähnlich 🙂🙂🙂 ähnlich", "abcabcabc" * 50):
        found = np.concatenate(list(features.blocks(text)))
        want = {int(toxicity.places(g)[-1]) for g in grams(text)}
        assert len(found) == len(set(found.tolist())) and set(found.tolist()) == want
    whole = np.concatenate(list(features.blocks("the quick brown fox " * 40)))
    monkeypatch.setattr(toxicity, "BLOCK", 7)  # blocks overlap: nothing is lost or counted twice
    parts = np.concatenate(list(features.blocks("the quick brown fox " * 40)))
    assert sorted(parts) == sorted(whole)


def test_ratios():
    r = toxicity.ratios(np.array([0, 10, 0, 5]), np.array([0, 0, 90, 45]), 10, 90, smoothing=4)
    assert abs(r[0]) < 1e-6 and abs(r[3]) < 1e-6  # never seen, and equally common
    assert r[1] == pytest.approx(math.log((10 + 0.4) / 3.6) - math.log(1 / 9), abs=1e-5) and r[2] < 0


def test_score_is_the_weighted_sum():
    weights = np.random.default_rng(1).standard_normal(1 << toxicity.TABLE).astype(np.float32)
    model = toxicity.Model(weights, bias=0.25)
    text = "some text, some words"
    z = 0.25 + sum(float(weights[int(toxicity.places(g)[-1])]) for g in grams(text))
    assert model.scores(iter([text, None]), toxicity.Features()) == pytest.approx([1 / (1 + math.exp(-z)), 1 / (1 + math.exp(-0.25))], rel=1e-4)


@pytest.fixture(scope="module")
def planted():
    """Invented words; a fifth of the texts holds some of four toxic ones, one text is very long."""
    pick = random.Random(3)
    stems = ["ran", "tel", "mo", "vis", "ku", "ber", "shi", "pel", "tor", "an"]
    bad = ["grobzak", "vlithe", "snurgle", "prakt"]
    docs, labels = [], []
    for i in range(600):
        words = ["".join(pick.choices(stems, k=pick.randint(1, 4))) for _ in range(pick.randint(5, 150))]
        toxic = i % 5 == 0
        for _ in range(pick.randint(2, 5) if toxic else 0):
            words.insert(pick.randrange(len(words)), pick.choice(bad))
        docs.append((i, " ".join(words), 9, 9.0))
        labels.append((i, 1, int(toxic)))
    clean = " ".join("".join(pick.choices(stems, k=3)) for _ in range(150_000))
    docs += [(9001, clean, 9, 9.0), (9002, clean + " grobzak vlithe snurgle grobzak", 9, 9.0), (9003, None, 9, 9.0), (9004, "", 9, 9.0), (None, "mo vis", 9, 9.0)]
    labels += [(None, 1, 1), (3, None, None), (9003, 1, 0), (9003, 1, 1)]
    return docs, labels


def test_planted_words_are_found_in_held_out_texts(spark, planted):
    docs, labels = planted
    docs = docs + docs[:2]  # repeated rows
    out = toxicity.score(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(docs) and out[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 9000]
    assert all(r["held_out"] == (fold(r["doc_id"]) == 2) for r in out) and len(held) > 100
    assert all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[9001]["predicted"] == 0 and by[9002]["score"] > by[9001]["score"]
    assert by[9003]["score"] == by[9004]["score"]
    again = toxicity.score(spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(labels, LABELS)).collect()
    assert {r["doc_id"]: round(r["score"], 6) for r in again} == {r["doc_id"]: round(r["score"], 6) for r in out}


def test_labels_of_the_held_out_fold_are_not_used(spark, planted):
    docs, labels = planted
    docs = [d for d in docs if d[0] is not None and d[0] < 200]
    other = [(i, q, 1 - t if fold(i) == 2 and t is not None else t) for i, q, t in labels]
    df = spark.createDataFrame(docs, DOCS)
    a, b = (sorted(map(tuple, toxicity.score(df, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, other))
    assert a == b


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b c", 0, 0.0), (2, None, 0, 0.0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in toxicity.score(docs, none).collect()] == [0.5, 0.5]
    learned = [i for i in range(20) if fold(i) != 2]
    one = spark.createDataFrame([(i, 1, 1) for i in learned], LABELS)
    every = spark.createDataFrame([(i, "x", 0, 0.0) for i in learned], DOCS)
    assert {r["score"] for r in toxicity.score(every, one).collect()} == {1.0}
    assert toxicity.score(docs.limit(0), one).count() == 0
