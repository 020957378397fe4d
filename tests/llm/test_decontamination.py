import hashlib
import re
from collections import Counter

from tessera.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, width):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add("" if i is None else str(i))
    out = Counter()
    for doc_id, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id, len(w), len(hit), len(found), sha, bool(hit)] += 1
    return out


def digest(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in df.collect())


def items(awkward):
    long = awkward[11][1].split()
    return [(1, " ".join(long[100:130])), (2, "A"), (3, None), (None, "a b c a b"), (4, "x"), (1, "Intro"), (5, ""), (6, "the of"), (7, " ".join(long[125:140]).upper())]


def test_against_brute_force(spark, awkward, awkward_docs):
    q = items(awkward)
    found = D.decontaminate(awkward_docs, spark.createDataFrame(q, "item_id long, text string"), width=10)
    assert digest(found) == brute([(d, t) for d, t, *_ in awkward], q, 10)


def test_blocks_of_the_query_set(spark, awkward, awkward_docs, monkeypatch):
    monkeypatch.setattr(D.blocks, "__defaults__", (20,))
    q = items(awkward)
    found = D.decontaminate(awkward_docs, spark.createDataFrame(q, "item_id long, text string"), width=10)
    assert digest(found) == brute([(d, t) for d, t, *_ in awkward], q, 10)


def test_windows_of_a_block():
    import random

    rng = random.Random(3)
    q = [(str(k), " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 3, 4, 5, 30]))).encode()) for k in range(60)]
    counts = {x.encode(): n for n, x in enumerate("cabdgfe", 1)}  # no h
    for width in (1, 4, 50):
        b = D.Block.of(q).wait(width, counts)
        got = {w: ids for t in b.terms for w, ids in b.waiting(t) if not (t != min(w, key=counts.get))}
        want = {}
        for i, t in q:
            for w in D.windows(t, width):
                if b"h" not in w:
                    want.setdefault(w, set()).add(i)
        assert got == {w: sorted(ids) for w, ids in want.items()}
        assert sum(1 for t in b.terms for _ in b.waiting(t)) == len(want)


def test_a_full_block_is_bounded():
    """16 MB of items: what the driver holds and what is sent stay under 300 MB."""
    import pickle
    import random
    import tracemalloc

    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(60_000)]
    q = [(str(k), " ".join(rng.choices(vocabulary, k=400)).encode()) for k in range(6300)]
    assert sum(len(t) for _, t in q) > 15 << 20
    tracemalloc.start()
    read = D.Block.of(q)
    block = read.wait(10, {t: k for k, t in enumerate(read.terms)})
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(block.start) > 2_000_000 and peak < 300e6 and len(pickle.dumps(block)) < 100e6


def test_empty_tables(spark, awkward_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.decontaminate(no_docs, one).collect() == []
    rows = D.decontaminate(awkward_docs, none).collect()
    assert len(rows) == awkward_docs.count() and not any(r["contaminated"] for r in rows)


def test_keep_clean(spark, awkward, awkward_docs):
    q = items(awkward)
    kept = D.keep_clean(awkward_docs, spark.createDataFrame(q, "item_id long, text string"))
    assert kept.columns == awkward_docs.columns
    clean = Counter()
    for d, t, *_ in awkward:
        for row, n in brute([(d, t)], q, 10).items():
            clean[d, t] += n * (not row[-1])
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == +clean


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three"), (2, "three filler two one"), (3, "one a b c d e f g two three"), (4, "one two")], "doc_id long, text string")
    q = spark.createDataFrame([(9, "one two three")], "item_id long, text string")
    rows = D.decontaminate(docs, q, width=3, span=5).collect()
    assert {r["doc_id"]: [tuple(h) for h in r["near"]] for r in rows} == {1: [(0, 3)], 2: [(0, 3)], 3: [], 4: []}
    assert {r["doc_id"]: r["near_items"] for r in rows} == {1: ["9"], 2: ["9"], 3: [], 4: []}
    assert not any(r["hits"] for r in rows)


def covered_near(docs, items, width, span):
    out = Counter()
    for doc_id, t in docs:
        w, found, hit = words(t), set(), set()
        for i, x in items:
            y = words(x)
            for k in range(max(1, len(y) - width + 1) if y else 0):
                need = set(y[k : k + width])
                for a in range(len(w)):
                    for b in range(a + len(need) - 1, min(len(w), a + span)):
                        if need <= set(w[a : b + 1]):
                            found.add(str(i))
                            break
        out[doc_id, tuple(sorted(found))] += 1
    return out


def test_proximity_against_brute_force(spark):
    import random

    rng = random.Random(6)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40)))) for k in range(40)]
    q = [(k, " ".join(rng.choice("abcdefghi") for _ in range(rng.randrange(8)))) for k in range(12)]
    found = D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(q, "item_id long, text string"), width=4, span=6)
    assert Counter((r["doc_id"], tuple(r["near_items"])) for r in found.collect()) == covered_near(docs, q, 4, 6)
    assert digest(found) == brute(docs, q, 4)


def test_segments_hold_every_posting():
    held = [(k, w) for k, w in enumerate([[b"a", b"b"], [], [b"b", b"a", b"b"], [b"c"]])]
    s = {k: v[0] for k, v in D._segment(0, held, 10).items()}
    seg = D.Segment.of(s["term"], s["n_postings"], s["gaps"], s["first_position"], s["n_words"])
    assert {t: seg.postings(t).tolist() for t in (b"a", b"b", b"c")} == {b"a": [0, 23], b"b": [1, 22, 24], b"c": [35]}
    assert seg.phrase((b"a", b"b"), {}).tolist() == [0, 23]
    assert seg.doc_of(seg.phrase((b"b", b"a"), {})).tolist() == [2]
    assert seg.phrase((b"a", b"missing"), {}).tolist() == [] == seg.near((b"a", b"missing"), 5, {})
    empty = {k: v[0] for k, v in D._segment(0, [(1, [])], 10).items()}
    assert D.Segment.of(empty["term"], empty["n_postings"], empty["gaps"], empty["first_position"], empty["n_words"]).place == {}


def test_long_lists_are_read_back():
    import random

    rng = random.Random(1)
    held = [(k, [rng.choice([b"x", b"y", b"%d" % rng.randrange(3000)]) for _ in range(rng.randrange(3000))]) for k in range(120)]
    s = {k: v[0] for k, v in D._segment(0, held, 64).items()}
    seg = D.Segment.of(s["term"], s["n_postings"], s["gaps"], s["first_position"], s["n_words"])
    want = {}
    for (_, w), at in zip(held, s["first_position"].tolist()):
        for k, t in enumerate(w):
            want.setdefault(t, []).append(at + k)
    assert {t: seg.postings(t).tolist() for t in seg.place} == want
