import random
from collections import Counter

import numpy as np

import corpus_pipeline
from tessera.llm import near_copies as N
from tests.llm.conftest import DOCS


def shingles(t):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def firsts(rows):
    """doc_ids of the kept rows, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for k, (d, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(d)
    return Counter(min((d for d in g if d is not None), default=None) for g in groups.values())


def planted(rng, n, least, most):
    """``n`` texts and a copy of each with scattered words changed, of a similarity within the range."""
    rows = []
    while len(rows) < 2 * n:
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(120, 400))]
        copy = list(base)
        for _ in range(rng.randint(0, len(base) // 20)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        if least <= jaccard(shingles(" ".join(base)), shingles(" ".join(copy))) < most:
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    return rows


def kept(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    return Counter(r["doc_id"] for r in N.keep_first(docs, **options).collect())


def test_the_stage_takes_planted_copies(spark):
    rng = random.Random(3)
    near, far = planted(rng, 60, 0.8, 1.0), planted(rng, 20, 0.6, 0.8)
    rows = near + [(1000 + d, t) for d, t in far]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got >= {d for d, _ in near if d % 2 == 0} | {1000 + d for d, _ in far}
    missed = [d for d, _ in near if d % 2 and d in got]
    assert len(missed) <= 60 * (1 - N.recall(0.8))  # were all of them just at 0.8


def test_recall_of_pairs_at_the_least_similarity(spark):
    """Of pairs just at 0.8 and above, those found; more similar ones all meet."""
    found = {}
    for least, most in ((0.8, 0.83), (0.83, 0.9), (0.9, 1.0)):
        rows = planted(random.Random(8), 150, least, most)
        got = kept(spark, rows)
        found[least] = 1 - sum(1 for d in got if d % 2) / 150
    assert found[0.8] >= 0.9 and found[0.83] >= 0.95 and found[0.9] >= 0.99, found
    assert N.recall(0.8) > 0.9 and N.recall(0.9) > 0.99


def test_fingerprints():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 1 << 64, 700, np.uint64))
    mixed = []
    for k in range(1, N.WORDS + 1):
        x = h + np.uint64(k) * N._GOLDEN
        x = (x ^ (x >> np.uint64(30))) * N._MIX[0]
        x = (x ^ (x >> np.uint64(27))) * N._MIX[1]
        mixed.append([int(v) for v in x ^ (x >> np.uint64(31))])
    want = [sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in word) > len(h)) for word in mixed]
    w, flips = N.fingerprint(h)
    assert [x % (1 << 64) for x in w] == want
    votes = [abs(2 * sum(v >> b & 1 for v in mixed[0]) - len(h)) for b in range(N.BITS)]
    assert sorted(votes[flips[0] >> 5 * i & 31] for i in range(N.FLIPS)) == sorted(votes)[: N.FLIPS]


def test_crowds_and_chains(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(3):
        w = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for _ in range(40):  # each text a few words from the one before: chains, and distant ends
            w = list(w)
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    want = firsts(rows)
    assert kept(spark, rows) == want
    assert kept(spark, rows, crowded=2, block=2000, entries=20) == want


def test_awkward(spark, awkward, awkward_docs, no_docs):
    got = N.keep_first(awkward_docs)
    assert got.columns == awkward_docs.columns
    assert Counter(r["doc_id"] for r in got.collect()) == firsts([(d, t) for d, t, *_ in awkward])
    assert N.keep_first(no_docs).collect() == []
