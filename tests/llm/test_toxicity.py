import random
import zlib

import numpy as np

from tessera.llm import toxicity as T
from tests.llm.conftest import prose

BAD = ["grumbel", "snarfix", "blorquez"]


def corpus(n=400):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        t, y = prose(rng, rng.randint(30, 200)), int(k % 4 == 0)
        if y:
            s = t.split(". ")
            at = rng.randrange(len(s))
            s[at] = f"{s[at]} {rng.choice(BAD)} {s[at][:3]}"
            t = ". ".join(s)
        rows.append((k, t, y))
    return rows


def test_held_out_accuracy_and_places(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in T.detect(docs, labels).collect()}
    held = [(k, t, y) for k, t, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k, r in got.items() if r["held_out"]} == {k for k, _, _ in held}
    assert np.mean([got[k]["predicted"] == y for k, _, y in held]) > 0.95
    for k, t, y in held:
        if y and got[k]["predicted"]:
            assert any(b in t[s["start"] : s["end"]] for s in got[k]["offending"] for b in BAD)


def test_awkward_rows(spark, awkward_docs, no_docs):
    labels = spark.createDataFrame([(8, 1), (8, 1), (9, None), (None, 0), (10, 7), (20, 0), (21, 1)], "doc_id long, toxic int")
    rows = T.detect(awkward_docs, labels).collect()
    assert len(rows) == awkward_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert T.detect(no_docs, labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(0 <= r["score"] <= 1 for r in T.detect(awkward_docs, none).collect())


def test_noisy_or():
    m = T.NoisyOr({"bad": 3.0}, -2.0)
    p = lambda z: 1 / (1 + np.exp(-z))
    score, found = m.document("All good. A bad one! Fine", worst=True)
    assert np.isclose(score, 1 - (1 - p(-2)) ** 2 * (1 - p(1)))
    assert [(a, b) for a, b, _ in found] == [(9, 19)] and np.isclose(found[0][2], p(1))
    assert m.document(None) == (0.0, []) and m.document("... !") == (0.0, [])


def test_sentences_have_places_in_the_text():
    t = "É one. İ two!\n\nthree"
    assert [t[a:b].strip() for a, b in T.sentences(t)] == ["É one", "İ two", "three"]


def test_training_without_one_label():
    z = np.zeros(0, np.int64)
    m = T.train(T.Bags(np.array([0, 0]), np.array([0, 1]), z, z), [])
    assert m.weights == {} and m.document("a b c.")[0] < 0.5
