import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import sharding as S


def check(rows, docs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = {}
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(shards)]
    largest = max((r["size"] for r in rows), default=0)
    assert all(abs(z - sum(sizes) / shards) <= largest for z in sizes)


def test_awkward(spark, awkward, awkward_docs):
    check(S.shard(awkward_docs).collect(), [(d, t) for d, t, *_ in awkward], 24)
    check(S.shard(awkward_docs, 3).collect(), [(d, t) for d, t, *_ in awkward], 3)


def test_one_text_holds_most_rows(spark):
    docs = [(k, "the same" if k % 3 else f"other {k}") for k in range(2000)]
    rows = S.shard(spark.createDataFrame(docs, "doc_id long, text string"), 24).collect()
    check(rows, docs, 24)
    same = [{r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"the same")}]
    assert len(same[0]) <= 18  # neighbours: two thirds of the shards and their edges


def by_plain_sort(spark, docs, shards, **options):
    """Rows by shard and slot next to all rows in the order of their keys."""
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["shard"], r["slot"], r["doc_id"], r["text_crc32"]) for r in S.shard(df, shards, **options).collect())
    keys = sorted((r["k1"], r["k2"], r["k3"], r["doc_id"], r["text_crc32"]) for r in S.keyed(df).collect())
    return [x[2:] for x in got], [x[3:] for x in keys]


def test_the_order_is_that_of_the_keys(spark):
    rng = random.Random(3)
    docs = [(k, "the same" if k % 3 else f"other {k}") for k in range(3000)]
    docs += [(7, "twice")] * 700 + [(None, "x")] * 300 + [(k, None) for k in range(200)]
    rng.shuffle(docs)
    for shards in (1, 5, 24):
        got, want = by_plain_sort(spark, docs, shards)
        assert got == want
    got, want = by_plain_sort(spark, docs, 5, least_cell=20)
    assert got == want


def test_equal_texts_are_neighbours(spark):
    docs = [(k, "the same" if k % 3 else f"other {k}") for k in range(3000)]
    got, _ = by_plain_sort(spark, docs, 24)
    at = [k for k, (_, crc) in enumerate(got) if crc == zlib.crc32(b"the same")]
    assert at == list(range(at[0], at[0] + 2000))


def test_cells_hold_few_rows(spark):
    docs = [(k, "the same" if k % 3 else f"other {k}") for k in range(3000)] + [(7, "twice")] * 500
    rows = S.keyed(spark.createDataFrame(docs, "doc_id long, text string")).cache()
    starts = sorted(set(S.splitters(rows, 100, 0.5, F.lit(1))))
    got = rows.select("k1", "k2", "k3", S.cell_of(starts).alias("cell")).collect()
    key = lambda r: sum((r[w] + (1 << 63)) << (128 - 64 * k) for k, w in enumerate(S.WORDS))
    assert all(r["cell"] == sum(key(r) >= s for s in starts) for r in got)
    assert max(Counter(r["cell"] for r in got).values()) <= 70
    rows.unpersist()


def test_identical_rows(spark):
    docs = [(1, "x")] * 500
    rows = S.shard(spark.createDataFrame(docs, "doc_id long, text string"), 24).collect()
    check(rows, docs, 24)
    n = Counter(r["shard"] for r in rows)
    assert max(n.values()) - min(n.values()) <= 1


def test_no_rows(no_docs):
    assert S.shard(no_docs).collect() == []


def test_no_python_in_the_plan(awkward_docs):
    assert not re.search("Python|Pandas|Arrow", S.shard(awkward_docs)._jdf.queryExecution().toString())
    assert not re.search("ExistingRDD", S.shard(awkward_docs)._jdf.queryExecution().toString())
    assert not re.search("Python|Pandas|Arrow", S.keyed(awkward_docs)._jdf.queryExecution().toString())
