import random
from collections import Counter

import numpy as np
import xxhash

from tessera.llm import simhash as S
from tessera.llm.components import components
from tests.llm.conftest import prose


def fingerprint(t):
    w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        r = find(k)
        if d is not None and (r not in least or d < least[r]):
            least[r] = d
    return Counter((d, fps[k], least.get(find(k))) for k, (d, _) in enumerate(rows))


def unsigned(x):
    return x % (1 << 64)


def test_against_brute_force(spark, awkward, awkward_docs):
    got = Counter((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in S.near_duplicates(awkward_docs).collect())
    assert got == brute([(d, t) for d, t, *_ in awkward])


def test_near_copies(spark):
    rng = random.Random(9)
    rows = []
    for k in range(25):
        base = prose(rng, 250).split(" ")
        for c in range(6):
            w = list(base)
            for _ in range(c):
                w[rng.randrange(len(w))] = "changed"
            rows.append((100 * k + c, " ".join(w)))
    got = Counter((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def test_keep_first(spark, awkward, awkward_docs, no_docs):
    kept = S.keep_first(awkward_docs)
    assert kept.columns == awkward_docs.columns
    want = {c for _, _, c in brute([(d, t) for d, t, *_ in awkward])}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(want)
    assert S.keep_first(no_docs).collect() == []
    assert S.near_duplicates(no_docs).collect() == []


def links_of(spark, values, **options):
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    return {tuple(sorted((unsigned(r["a"]), unsigned(r["b"])))) for r in S.links(df, **options).collect()}


def test_all_links_are_found(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(20):
        v = rng.getrandbits(64)
        values |= {v} | {v ^ sum(1 << b for b in rng.sample(range(64), r)) for r in (1, 2, 3, 4, 5, 6) for _ in range(4)}
    values = sorted(values)
    want = {(a, b) for i, b in enumerate(values) for a in values[:i] if (a ^ b).bit_count() <= 4}
    for n in (2, 3, 4):
        assert links_of(spark, values, n_segments=n, crowded=10_000) == want


def _classes(values, links):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


def test_crowded_values_keep_what_is_connected(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    values = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(300)})
    want = {(a, b) for i, b in enumerate(values) for a in values[:i] if (a ^ b).bit_count() <= 4}
    got = links_of(spark, values, crowded=3, block=40)
    assert got <= want and _classes(values, got) == _classes(values, want)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (500, 400), (500, 400), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 1 for k in range(1, 61)} | {100 + k: 100 for k in range(40)} | {400: 400, 500: 400}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_segments_and_balls():
    assert sum(b for _, b in S.segments(3)) == 64
    assert len(S.balls(21, 1)) == 21 and len(S.balls(32, 2)) == 32 + 31 * 16
