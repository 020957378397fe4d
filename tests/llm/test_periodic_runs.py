import random
import time
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

from tessera.llm import periodic_runs as P


def plain_runs(w):
    """Every stretch that is long enough, tried with every period, straight from the definition."""
    n, out = len(w), set()
    for p in range(1, n // 4 + 1):
        k = 0
        while k + p < n:
            if w[k] != w[k + p]:
                k += 1
                continue
            e = k
            while e + p < n and w[e] == w[e + p]:
                e += 1
            stretch = w[k : e + p]
            smallest = next(q for q in range(1, p + 1) if all(stretch[i] == stretch[i + q] for i in range(len(stretch) - q)))
            if smallest == p and len(stretch) >= max(6, 4 * p):
                out.add((k, e + p, p))
            k = e + 1
    return sorted(out)


def plain_row(doc_id, text):
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    figures = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    h = lambda s: sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (doc_id, len(found), *figures, h(listed), h(" ".join(x for i, x in enumerate(w) if i not in dropped)), n, len(dropped))


def planted(rng, n, letters):
    w = []
    while len(w) < n:
        if rng.random() < 0.5:
            w += [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        else:
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 14))]
            w += (unit * 9)[: rng.randint(len(unit), 7 * len(unit))]
    return w


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 40, 5000])
def test_equal_to_the_definition(letters):
    rng = random.Random(letters)
    for _ in range(150):
        w = planted(rng, rng.choice([0, 3, 6, 7, 12, 30, 90, 200]), letters)
        assert P.runs(np.array(w, np.int64)) == plain_runs(w)


def test_all_short_texts_of_two_words():
    for n in range(15):
        for bits in range(1 << n):
            w = [bits >> k & 1 for k in range(n)]
            assert P.runs(np.array(w, np.int64)) == plain_runs(w)


def test_runs_next_to_and_inside_each_other():
    a, b, c = [1, 2] * 20, [1, 2, 3] * 15, [7] * 30
    for w in (a + b, b + a, a + c + a, (c + b) * 5, (a + [9]) * 6, ([1] * 6 + [2]) * 7, b[:-1] + b[1:] + c + c, ([1, 1, 2, 2] * 6 + [3]) * 5):
        assert P.runs(np.array(w, np.int64)) == plain_runs(w)


def test_many_planes_and_long_periods():
    rng = random.Random(1)
    unit = [rng.randrange(10**6) for _ in range(700)]
    w = P.numbered([str(x) for x in [*unit[300:], *unit, *unit, *unit, *unit[:350], *range(2000)]])
    assert P.runs(w) == [(0, 400 + 3 * 700 + 350, 700)]
    assert P.runs(w[: 4 * 700 - 1]) == []


def test_rows(spark, awkward, awkward_docs, no_docs):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_dropped"]
    got = [tuple(r[c] for c in columns) for r in P.detect(awkward_docs).collect()]
    short = [(r[0], r[1]) for r in awkward if len(r[1] or "") < 9000]
    want = [plain_row(*r) for r in short]
    key = lambda r: (r[0] is None, str(r))
    assert sorted((r for r in got if r[8] < 1500), key=key) == sorted(want, key=key) and len(got) == len(awkward)
    assert P.detect(no_docs).collect() == []


def test_query(spark, sf):
    from tessera.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    few = [r for r in docs if len(r["text"] or "") < 6000]
    assert len(got) == len(docs) and len(few) > 100 and sum(r[1] > 0 for r in got.values()) > 5
    for r in few:
        assert got[r["doc_id"]] == plain_row(r["doc_id"], r["text"])[: len(got[r["doc_id"]])]


def test_long_texts_end():
    """Half a million words: prose, one word over and over, and a unit of 50,000 words ten times over."""
    rng = np.random.default_rng(5)
    prose = rng.zipf(1.3, 500_000).astype(np.int64) % (1 << 30)
    began = time.perf_counter()
    P.runs(np.unique(prose, return_inverse=True)[1])
    assert P.runs(np.zeros(500_000, np.int64)) == [(0, 500_000, 1)]
    assert (0, 500_000, 50_000) in P.runs(np.unique(np.tile(prose[:50_000], 10), return_inverse=True)[1])
    assert time.perf_counter() - began < 60
