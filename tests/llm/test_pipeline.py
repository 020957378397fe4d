"""The corpus pipeline against a plain Python version of each stage, and the registered queries on a small table."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from tessera.llm import secrets
from tessera.llm.common import stored
from tessera.llm.queries import QUERIES
from tests.llm import test_decontamination as D
from tests.llm import test_near_copies as N


@pytest.fixture(scope="module")
def staged(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, stored(f(spark, docs, sf), name)
        out.append((name, before, docs))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(staged):
    assert [n for n, _, _ in staged] == ["quality_classifier", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, before, after in staged[:-1]:
        assert after.columns == before.columns


def test_quality(spark, sf, staged):
    _, before, after = staged[0]
    good = {r["doc_id"] for r in QUERIES["op5_quality_classifier"](spark, sf).where("predicted = 1").collect()}
    assert {d for d, _ in rows(after)} == good and before.count() > after.count() > 0


def test_near_duplicates(staged):
    _, before, after = staged[1]
    all_, firsts, got = Counter(d for d, _ in rows(before)), N.firsts(rows(before)), Counter(d for d, _ in rows(after))
    assert not firsts - got  # nothing goes that has no copy
    assert (got - firsts).total() <= 0.1 * (all_ - firsts).total()  # copies that stay; see the README


def test_decontamination(spark, sf, staged):
    _, before, after = staged[2]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {d for (d, *_, hit) in D.brute(rows(before), items, 10) if not hit}
    assert {d for d, _ in rows(after)} == clean


def test_secrets(staged):
    _, before, after = staged[3]
    assert sorted(rows(after)) == sorted((d, secrets.redacted(t)) for d, t in rows(before))


def test_packing(staged):
    _, before, after = staged[4]
    assert {r["doc_id"] for r in after.collect()} == {d for d, _ in rows(before)}
    assert Counter(r["doc_id"] for r in after.where("piece = 0").collect()) == Counter(d for d, _ in rows(before))


def test_awkward_tables(spark, sf, awkward, awkward_docs, no_docs):
    """Nulls, empties, repeated rows, clashing columns, no rows: stages take them, and columns go through."""
    for table, n in ((awkward_docs, len(awkward)), (no_docs, 0)):
        docs = table
        for name, f in corpus_pipeline.STAGES[:-1]:
            after = stored(f(spark, docs, sf), name)
            assert after.columns == table.columns and after.count() <= docs.count() <= n
            docs = after
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
        assert sum(r["piece"] == 0 for r in packed) == docs.count()


def test_each_stage_alone_takes_awkward_rows(spark, sf, awkward, awkward_docs):
    for _, f in corpus_pipeline.STAGES[1:-1]:
        ids = Counter(r["doc_id"] for r in f(spark, awkward_docs, sf).collect())
        assert ids and not ids - Counter(d for d, *_ in awkward)


def test_the_shared_folder_is_asked_for_off_one_machine():
    from types import SimpleNamespace

    from tessera.llm.common import shared_dir

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://far:7077"))
    with pytest.raises(ValueError):
        shared_dir(bare)


def test_run_is_the_stages(spark, sf, staged):
    key = lambda df: Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(staged[-1][2])


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_give_a_row_for_each_document(spark, sf, name):
    table, key = ("embeddings", "vec_id") if name == "op11_embedding_whitening" else ("documents", "doc_id")
    ids = {r[key] for r in QUERIES[name](spark, sf).select(key).collect()}
    assert ids == {r[key] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect()}


def test_digests_are_lowercase_hex(spark, sf):
    r = QUERIES["op6_simhash_near_dedup"](spark, sf).collect()
    assert all(len(x["fingerprint"]) == 16 and x["fingerprint"] == x["fingerprint"].lower() for x in r)
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_stages_chained_before_any_is_written(spark, sf, staged):
    """A stage takes what the one before it has not written yet, and another run in between disturbs neither."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lazy = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, sf), sf)
    other = corpus_pipeline.quality(spark, docs.limit(40), sf)
    clean = corpus_pipeline.decontaminate(spark, lazy, sf)
    assert Counter(rows(clean)) == Counter(rows(staged[2][2])) and other.count() <= 40
    assert Counter(rows(lazy)) == Counter(rows(staged[1][2]))
