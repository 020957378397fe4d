import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_classifier as Q
from tests.llm.conftest import prose, words

LABELS = "doc_id long, quality int"


def corpus(n=200):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randint(60, 300)), 1) for k in range(n)]
    rows += [(n + k, " ".join(w + "###" for w in words(rng, 150)), 0) for k in range(n // 3)]
    rows += [(2 * n + k, " ".join(["spam", "eggs"] * 90), 0) for k in range(n // 3)]
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], LABELS)
    got = {r["doc_id"]: r for r in Q.classify(docs, labels).collect()}
    held = [(k, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert {k for k, r in got.items() if r["held_out"]} == {k for k, _ in held}
    assert np.mean([got[k]["predicted"] == y for k, y in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_held_out_labels_are_not_read(spark):
    rows = corpus(90)
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], LABELS)
    turned = labels.withColumn("quality", F.when(Q.remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], round(r["score"], 12)) for r in Q.classify(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_awkward_rows(spark, awkward_docs, no_docs):
    labels = spark.createDataFrame([(8, 1), (8, 1), (9, None), (None, 0), (10, 7), (20, 0), (21, 1), (999, 1)], LABELS)
    rows = Q.classify(awkward_docs, labels).collect()
    assert len(rows) == awkward_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.classify(no_docs, labels).collect() == []
    none = spark.createDataFrame([], LABELS)
    assert all(0 <= r["score"] <= 1 for r in Q.classify(awkward_docs, none).collect())


def test_keep_good_keeps_columns(spark, awkward_docs, no_docs):
    labels = spark.createDataFrame([(k, int(k % 2)) for k in range(50)], LABELS)
    kept = Q.keep_good(awkward_docs, labels)
    assert kept.columns == awkward_docs.columns and kept.count() <= awkward_docs.count()
    assert Q.keep_good(no_docs, labels).collect() == []


def test_expression_agrees_with_numpy(spark):
    rng = np.random.default_rng(1)
    x = {y: rng.normal(y, 1 + y, (50, 3)) for y in (0, 1)}
    model = Q.fit({y: (50, v.sum(0), v.T @ v) for y, v in x.items()})
    probe = rng.normal(0, 3, (20, 3))
    df = spark.createDataFrame(probe.tolist(), "a double, b double, c double")
    got = [r["s"] for r in df.select(model.score_column(["a", "b", "c"]).alias("s")).collect()]
    assert np.allclose(sorted(got), sorted(model.score(probe)))


def test_density_is_gaussian():
    cov, mean = np.array([[2.0, 0.3], [0.3, 1.0]]), np.array([1.0, -1.0])
    c = Q.Class.of(1.0, mean, cov)
    x = np.array([0.5, 0.2])
    want = -0.5 * (x - mean) @ np.linalg.inv(cov) @ (x - mean) - 0.5 * np.log(np.linalg.det(cov))
    assert np.isclose(c.log_density(x[None])[0], want)
