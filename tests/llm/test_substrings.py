import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import substrings as S
from tests.llm.conftest import prose


def brute(rows, width):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    n = Counter(tuple(w[i : i + width]) for w in docs for i in range(len(w) - width + 1))
    out = Counter()
    for (d, _), w in zip(rows, docs, strict=True):
        gone = {j for i in range(len(w) - width + 1) if n[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def digest(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def test_against_brute_force(spark, awkward, awkward_docs):
    assert digest(S.repeated_words(awkward_docs)) == brute([(d, t) for d, t, *_ in awkward], 35)


def test_small_windows_and_chunks(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, period, cover in ((8, 7, (0, 1, 3)), (7, 7, (0, 1, 3)), (5, 3, (0, 1)), (4, 1, (0,))):
        assert digest(S.repeated_words(df, width, period, cover, chunk_bytes=(300, 300), bucket_bytes=(100, 100))) == brute(rows, width)


def test_shifted_passages(spark):
    rng = random.Random(5)
    passage = prose(rng, 51)
    rows = [(k, f"{prose(rng, k)} {passage} {prose(rng, 40)}") for k in range(25)] + [(99, prose(rng, 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.repeated_words(df, with_text=True).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute(rows, 35)
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_anchors_do_not_depend_on_the_order_of_a_chunk():
    rng = random.Random(8)
    texts = [prose(rng, n).encode() for n in (60, 35, 101, 1, 44, 200)]
    found = [set(S.Chunk(t, S.WIDTH, S.PERIOD, S.COVER).anchors()[1].tolist()) for t in (texts, texts[::-1], texts[3:] + texts[:3])]
    assert found[0] and found[0] == found[1] == found[2]


def test_the_cover_is_checked(spark, no_docs):
    with pytest.raises(ValueError):
        S.repeated_words(no_docs, 35, 21, (0, 1, 2))
    with pytest.raises(ValueError):
        S.repeated_words(no_docs, 10, 21, S.COVER)
    assert S.repeated_words(no_docs).collect() == []


def test_distinct_digests_that_agree_in_their_first_part():
    d = S.Digests(np.array([5, 5, 5, 2], np.uint64), np.array([1, 2, 1, 9], np.uint32))
    distinct, counts, which = d.distinct()
    assert list(zip(distinct.a.tolist(), distinct.b.tolist(), counts.tolist(), strict=True)) == [(2, 9, 1), (5, 1, 2), (5, 2, 1)]
    assert which.tolist() == [1, 2, 1, 0]
    again = S.Digests.unpack([d.pack(), d.pack()], True)
    assert again.a.tolist() == d.a.tolist() * 2 and again.b.tolist() == d.b.tolist() * 2
