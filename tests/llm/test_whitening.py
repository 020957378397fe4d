import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>"


def plain(rows, components=8):
    """The same by Python integers, one vector at a time."""
    kept = []
    for vec_id, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]))
    n, d = len(kept), len(kept[0][1])
    total = [sum(x[k] for _, x in kept) for k in range(d)]
    y = [[n * x[k] - total[k] for k in range(d)] for _, x in kept]
    cov = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    deviation = [sum(a * a for a in r) for r in y]
    values, vectors = np.linalg.eigh(cov)
    z = np.array(y, dtype=float) / n @ vectors[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])
    return [(k, dev, list(row)) for (k, _), dev, row in zip(kept, deviation, z, strict=True)], values[::-1][:components] / np.trace(cov)


def test_equal_to_integers_one_by_one(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1 + j) * (1 if k % 3 else 0.1) + j for j in range(12)]) for k in range(300)]
    rows += [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [0.5] * 5), rows[7]]
    got = W.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    want, explained = plain([r for r in rows if r[0] != 905])
    assert len(got) == 8 * len(want) and {r["n"] for r in got} == {301}
    by_id = {(r["vec_id"], r["component"]): r for r in got}
    for vec_id, deviation, z in want:
        mine = [by_id[vec_id, c] for c in range(1, 9)]
        assert {r["deviation"] for r in mine} == {deviation} == {int(mine[0]["deviation_digits"])}
        for c, r in enumerate(mine):
            sign = np.sign(np.dot([by_id[w[0], c + 1]["whitened"] for w in want], [w[2][c] for w in want]))
            assert math.isclose(r["whitened"] * sign, z[c], rel_tol=1e-8, abs_tol=1e-8)
            assert math.isclose(r["explained"], explained[c], rel_tol=1e-9)
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("largest", [0, 1, 700, 1 << 20, 1 << 40, (1 << 62) - 1])
def test_limb_products_are_exact(largest):
    rng = random.Random(largest)
    y = [[rng.randint(-largest, largest) for _ in range(5)] for _ in range(70)]
    y[0], y[1] = [largest] * 5, [-largest] * 5
    g = W.Gram(5, largest)
    for k in range(0, 70, 9):
        g.add(np.array(y[k : k + 9], np.int64), rows=4)
    total, products = g.result()
    assert list(total) == [sum(r[i] for r in y) for i in range(5)]
    assert [list(r) for r in products] == [[sum(r[i] * r[j] for r in y) for j in range(5)] for i in range(5)]


def test_full_accumulators_move_to_big_integers(monkeypatch):
    monkeypatch.setattr(W, "LIMB", 25)  # then 8 rows fill a float
    y = np.full((100, 3), (1 << 25) - 1, np.int64)
    g = W.Gram(3, int(y.max()))
    g.add(y, rows=5)
    total, products = g.result()
    assert set(total) == {100 * int(y[0, 0])} and set(products.ravel()) == {100 * int(y[0, 0]) ** 2}


def test_digits_there_and_back():
    x = np.array([0, 1, -1, 1 << 95, -(1 << 95), (1 << 119) - 1, -(1 << 119)], object)
    digits = W.to_digits(x, 4)
    assert list(W.from_digits(digits)) == list(x)
    assert list(W.from_digits(digits * 3)) == [3 * v for v in x]


def test_far_from_the_mean(spark):
    """Long range of values: deviations do not fit a long, the digits do; covariance as by Python's integers."""
    rows = [(k, [1e9 * (k % 3), 5.0 + k, -1e14 + 7 * k * k]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    f = W.fit(df)
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    total = [sum(r[k] for r in x) for k in range(3)]
    want = [[sum((40 * r[i] - total[i]) * (40 * r[j] - total[j]) for r in x) for j in range(3)] for i in range(3)]
    assert [[40 * v for v in r] for r in f.products] == want
    got = {r["vec_id"]: r for r in W.whiten(df).where("component = 1").collect()}
    for k, r in enumerate(x):
        exact = sum((40 * r[j] - total[j]) ** 2 for j in range(3))
        assert int(got[k]["deviation_digits"]) == exact and got[k]["deviation"] == (exact if exact < 1 << 63 else None)


def test_order_and_partitions_do_not_matter(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    a, b = W.fit(df.coalesce(1)), W.fit(df.orderBy(F.rand(3)).repartition(7))
    assert (a.products == b.products).all() and (a.components == b.components).all()


def test_awkward_rows(spark):
    huge = 3e38
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.0]), (2, [huge, 1.0]), (3, []), (4, None), (5, [1.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("pos", "component", "n", "whitened", "part", "row", "digits", "d")})
    got = W.whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert all(r["whitened"] is None for r in got if r["component"] == 2) and all(r["whitened"] is not None for r in got if r["component"] == 1)
    one = W.whiten(df.where("get(embedding, 1) = 4.0")).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 2
    assert W.whiten(df.where("false")).collect() == [] and W.whiten(df.where("embedding is null")).collect() == []
