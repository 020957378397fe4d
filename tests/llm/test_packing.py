import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing as P


def run(df):
    return P.pack(df).collect()


def test_round_trip(spark, awkward, awkward_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = run(awkward_docs)
    ids = [reference.encode(t or "", add_special_tokens=False).ids + [0] for _, t, *_ in awkward]
    wanted = Counter()
    for (doc_id, *_), x in zip(awkward, ids, strict=True):
        for k, (start, n) in enumerate(P.cut(len(x), 2048)):
            wanted[doc_id, k, start, n, zlib.crc32(np.array(x[start : start + n], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(map(len, ids)) // 2048) + 1


def test_long_runs_give_the_ids_of_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    reference, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), P.tokenizer("byte_bpe_50k")
    texts = ["a" + " " * 1_000_000 + "x", "z" * 200_000, "ab" * 1500 + "\n" * 3000 + " end", "\u3000" * 2500, " " * 1999 + "x", "q" * 1999, "-" * 5000]
    for t in texts:
        assert own(t) == reference.encode(t, add_special_tokens=False).ids


def test_a_document_of_blanks_is_packed(spark):
    rows = run(spark.createDataFrame([(1, "a" + " " * 1_000_000 + "x"), (2, None)], "doc_id long, text string"))
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1_000_002 and len(rows) == -(-1_000_002 // 2048) + 1


def test_no_rows(spark, no_docs):
    assert run(no_docs) == []


def test_cut():
    assert P.cut(2048, 2048) == [(0, 2048)]
    assert P.cut(2049, 2048) == [(0, 1), (1, 2048)]
    assert P.cut(1, 2048) == [(0, 1)]
    assert P.cut(6000, 2048) == [(0, 1904), (1904, 2048), (3952, 2048)]


def _used(runs):
    c = Counter()
    for n, lengths in runs:
        for x in lengths:
            c[x] += n
    return c


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_plan_uses_everything(histogram):
    runs = P.plan(histogram, 64)
    assert _used(runs) == Counter(histogram)
    assert all(n > 0 and sum(lengths) <= 64 for n, lengths in runs)
    total = sum(k * n for k, n in histogram.items())
    large = sum(n for k, n in histogram.items() if k > 32)
    bins = sum(n for n, _ in runs)
    assert max(-(-total // 64), large) <= bins
    assert bins <= 1.5 * max(-(-total // 64), large) + 1


def test_plan_takes_exact_singles_pairs_and_triples():
    assert sum(n for n, _ in P.plan({60: 5, 40: 5}, 100)) == 5
    assert sum(n for n, _ in P.plan({50: 4, 30: 4, 20: 4}, 100)) == 4
    assert sum(n for n, _ in P.plan({40: 3, 30: 3, 20: 3, 10: 3}, 100)) == 3
    assert P.plan({}, 100) == []
    assert sum(n for n, _ in P.plan({10: 1_000_003}, 100)) == 100_001


def least_sequences(lengths, capacity):
    """By trying all placements."""
    best = [len(lengths)]

    def go(k, gaps):
        if len(gaps) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(gaps)
            return
        for g in sorted(set(gaps)):
            if g >= lengths[k]:
                rest = list(gaps)
                rest.remove(g)
                go(k + 1, [*rest, g - lengths[k]])
        go(k + 1, [*gaps, capacity - lengths[k]])

    go(0, [])
    return best[0]


def test_plan_against_the_optimum():
    import random

    rng, more = random.Random(2), 0
    for _ in range(300):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        least = least_sequences(lengths, 20)
        got = sum(n for n, _ in P.plan(dict(Counter(lengths)), 20))
        assert least <= got <= least + 1
        more += got > least
    assert more <= 6


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=12), st.integers(1, 60))
def test_sums_name_what_counts_allow(histogram, gap):
    counts = np.zeros(61, np.int64)
    for k, n in histogram.items():
        counts[k] = n
    pieces = sorted(Counter(histogram).elements())
    pairs = {(pieces[j], pieces[i]) for j in range(len(pieces)) for i in range(j) if pieces[i] + pieces[j] == gap}
    sums = P.Sums(counts)
    assert sums.pair(gap) == max(pairs, default=None)
    triples = {(pieces[k], pieces[j], pieces[i]) for k in range(len(pieces)) for j in range(k) for i in range(j) if pieces[i] + pieces[j] + pieces[k] == gap}
    found = sums.triple(gap)
    assert (found is not None) == bool(triples)
    if found:
        assert sum(found) == gap and not Counter(found) - Counter(histogram)
    top = max((x for x in pieces if x <= gap), default=None)
    found = sums.filling(gap, ())
    fills = top == gap or (top is not None and any(x[0] == top for x in pairs | triples))
    assert (found is not None) == fills
    if found:
        assert sum(found) == gap and found[0] == top and not Counter(found) - Counter(histogram)


def test_sums_of_all_lengths_take_little_of_the_driver():
    tracemalloc.start()
    sums = P.Sums(np.ones(2049, np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sums.triple(2048) and peak < 40e6


def log_normal(seed, n):
    rng = np.random.default_rng(seed)
    tokens = np.exp(rng.normal(rng.uniform(4, 7.2), rng.uniform(0.5, 1.6), n)).astype(int) + 1
    return Counter(length for x in tokens for _, length in P.cut(int(x), 2048))


def test_the_plan_never_needs_more_than_best_fit():
    with_more = 0
    for seed in range(32):
        histogram = log_normal(seed, [300, 1000, 3000, 20000][seed % 4])
        runs = P.plan(histogram)
        assert _used(runs) == histogram
        left = np.zeros(2049, np.int64)
        for k, n in histogram.items():
            left[k] = n
        alone = P._complements(left, 2048) + P._fit(left, 2048)
        assert sum(n for n, _ in runs) <= sum(n for n, _ in alone)
        with_more += any(len(lengths) > 2 and sum(lengths) == 2048 for _, lengths in runs)
    assert with_more > 20  # filled exactly by three pieces or more


def test_runs_are_found_in_linear_time():
    import time

    encode = P.tokenizer("byte_bpe_50k")
    began = time.perf_counter()
    encode(("中文字符" * 450 + "\n") * 555)
    for text in (("x" * 1990 + " ") * 500, "x" * 1_000_000, " " * 1_000_000):
        P._SHORT_RUNS.fullmatch(text)
    assert time.perf_counter() - began < 2
    short = P._SHORT_RUNS.fullmatch
    assert short("") and short("a" * 1999 + " b") and not short("a" * 2000) and not short("b " + "\n" * 2000 + "c") and short(" " * 1999)


def test_plan_refuses_what_cannot_fit():
    with pytest.raises(ValueError):
        P.plan({101: 1}, 100)


def test_places_do_not_overlap():
    runs = P.plan({7: 9, 5: 4, 3: 11, 2: 2}, 16)
    seen = set()
    for length, lo, hi, per, first, offset in P.places(runs):
        for rank in range(lo, hi):
            s, o = first + (rank - lo) // per, offset + (rank - lo) % per * length
            for t in range(o, o + length):
                assert (s, t) not in seen and t < 16
                seen.add((s, t))
    assert len(seen) == 7 * 9 + 5 * 4 + 3 * 11 + 2 * 2
