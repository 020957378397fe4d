import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import languages as L
from tests.llm.conftest import DOCS

PIECES = {
    "en": ["the", "ing", "and", "tion", "wh", "ea"],
    "de": ["sch", "der", "ung", "ein", "ü", "ß"],
    "fr": ["eau", "que", "les", "ê", "oi", "ment"],
}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(PIECES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=360):
    rng = random.Random(4)
    rows = [(k, speech(rng, lang := rng.choice(sorted(PIECES)), rng.randint(1, 80)), lang, "s", 0) for k in range(n)]
    return rows + [rows[5]] * 30 + [(9001, speech(rng, "fr", 40), None, "s", 0)]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame(corpus(), DOCS).repartition(3)
    return docs, L.identify(docs, bits=12)


def test_held_out_accuracy(found):
    docs, got = found
    rows = {r["doc_id"]: r for r in got.collect()}
    held = [(k, lang) for k, _, lang, *_ in corpus() if lang and zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k, r in rows.items() if r["held_out"] and k < 9000} == {k for k, _ in held}
    assert np.mean([rows[k]["lang_pred"] == lang for k, lang in held]) > 0.97
    assert rows[9001]["lang_pred"] == "fr" and got.count() == docs.count()
    assert all(1 / 3 - 1e-9 <= r["score"] <= 1 for r in rows.values())


def test_accuracy_on_the_tables(spark, sf):
    from tessera.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    both = QUERIES["op13_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert right > 0.9


def test_held_out_labels_are_never_looked_at(found, spark):
    docs, got = found
    lied = docs.withColumn("lang", F.when(L.remainder("doc_id", 5) == 0, F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(got.collect(), key=str) == sorted(L.identify(lied, bits=12).collect(), key=str)


def test_grams():
    g = L.Grams(16)
    assert "".join(map(chr, g.codes("Das  ist\n\t3 Öl-Faß! "))) == " das ist öl faß "
    assert not len(g.codes("12 -- 3")) and not len(g.counts(None)[0]) and not len(g.counts("")[0])

    def plain(text):
        out = Counter()
        for n in L.GRAMS:
            for k in range(len(text) - n + 1):
                h = 0
                for j, c in enumerate(text[k : k + n]):
                    h = (h * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) + j + 1)
                out[(h * 0x9E3779B1 & 0xFFFFFFFF) >> 16] += 1
        return out

    for text in ("a", "Das ist 1 Öl", "日本語 テスト", "x" * 500):
        features, counts = g.counts(text)
        assert dict(zip(features.tolist(), counts.tolist(), strict=True)) == plain("".join(map(chr, g.codes(text))))


def test_leader_equals_a_plain_one():
    """Coordinate by coordinate, from the published update."""
    rng = random.Random(6)
    leader, z, n = L.Leader.new(6, 3), [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]

    def weight(i, k):
        if abs(z[i][k]) <= L.L1:
            return 0.0
        return -(z[i][k] - math.copysign(L.L1, z[i][k])) / ((L.BETA + math.sqrt(n[i][k])) / L.ALPHA + L.L2)

    for _ in range(60):
        at = sorted(rng.sample(range(6), 3))
        x, y = [rng.random() for _ in at], rng.randrange(3)
        leader.learn(np.array(at), np.array(x), y)
        place = [*zip(at, x, strict=True), (6, 1.0)]
        e = [math.exp(sum(v * weight(i, k) for i, v in place)) for k in range(3)]
        slope = [v / sum(e) - (k == y) for k, v in enumerate(e)]
        for i, v in place:
            for k in range(3):
                g, w = v * slope[k], weight(i, k)
                sigma = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / L.ALPHA
                z[i][k] += g - sigma * w
                n[i][k] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)
    assert np.allclose(leader.rows(slice(None)), [[weight(i, k) for k in range(3)] for i in range(7)])


def test_most_weights_are_zero(found):
    docs, _ = found
    model = L.learn(docs, bits=12)
    assert 0 < (model.weights != 0).mean() < 0.5


def test_document_frequencies(found):
    docs, _ = found
    texts = L.learnable(docs)
    n, total = L.document_frequencies(texts, 12)
    grams, want = L.Grams(12), Counter()
    rows = [r["text"] for r in texts.collect()]
    for t in rows:
        want.update(grams.counts(t)[0].tolist())
    assert n == len(rows) and {k: v for k, v in enumerate(total) if v} == dict(want)


def test_sample_is_bounded_and_takes_a_copy_once(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    got, languages = L.sample(L.learnable(docs), most=20)
    rows = got.collect()
    assert languages == ["de", "en", "fr"] and Counter(r["lang"] for r in rows) == dict.fromkeys(languages, 20)
    assert len({r["text"] for r in rows}) == 60


def test_temperature():
    model = L.Model(["a", "b"], np.ones(4), np.array([[1.0, 0], [0, 1.0], [0, 0], [0, 0], [0, 0]]))
    one = lambda k: (np.array([k]), np.array([1]))
    texts = [(0, *one(0))] * 6 + [(1, *one(0))] * 2 + [(1, *one(1))] * 6 + [(0, *one(1))] * 2
    t = L.temperature(*L.losses(model, texts), 2)
    assert abs(1 / (1 + math.exp(-1 / t)) - 0.75) < 0.03  # three of four are right
    right = [(0, *one(0))] * 50 + [(1, *one(1))] * 50
    assert 0.98 < 1 / (1 + math.exp(-1 / L.temperature(*L.losses(model, right), 2))) < 0.999
    assert L.temperature(0, np.zeros(5), np.zeros(5), 2) == 1.0
    assert model.predict(*one(0))[0] == "a" and model.predict(np.zeros(0, int), np.zeros(0, int)) == ("und", 0.0)


def test_awkward_rows(spark, awkward, awkward_docs, no_docs):
    rows = L.identify(awkward_docs, bits=10).collect()
    assert len(rows) == len(awkward) and all(0 <= r["score"] <= 1 for r in rows)
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in awkward if r[0] is not None}
    assert all((r["lang_pred"] == "en") == letters[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert L.identify(no_docs, bits=10).collect() == []
    unlabelled = L.identify(awkward_docs.withColumn("lang", F.lit(None).cast("string")), bits=10).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
