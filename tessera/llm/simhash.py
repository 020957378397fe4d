"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; two link at ``radius`` or fewer differing bits. Each
fingerprint is cut into segments. By the pigeonhole principle two linked fingerprints
differ in at most ``radius // segments`` bits of some segment, so a table of segment
values, asked for all values of that small Hamming ball around one's own, returns every
partner; the complete distance of each is then verified. Equal fingerprints are one
entry, whatever the number of their documents. A segment value that very many different
fingerprints share is not joined pair by pair: its members go to tasks in blocks that
link them into a forest there, so a bucket gives links in proportion to its members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, arrow_schema, fresh, stored
from tessera.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: A segment value with more fingerprints is linked in blocks.
CROWDED = 64
#: Fingerprints of a block.
BLOCK = 8192
#: Tasks over which the rows of one fingerprint are dealt.
SALTS = 8


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash, as a signed 64-bit integer, of a text (A-Z lower-cased, white-space words); zero without words."""
    import xxhash

    w = text.lower().split() if text else []  # bytes.lower() changes A-Z only
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(line, SEED)).astype(np.int64))
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(w) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, stops, strict=True)), np.uint64, len(starts))
    bits = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):  # bounded memory for very long texts
        bits += np.unpackbits(h[k : k + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id, fp."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"doc_id": b["doc_id"], "fp": [fingerprint(t, shingle) for t in b["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.col("text").cast("binary").alias("text")), rows, f"doc_id {kind}, fp long")


def segments(n: int) -> list[tuple[int, int]]:
    """(shift, bits) of ``n`` nearly equal segments of 64 bits."""
    out, at = [], 0
    for k in range(n):
        bits = 64 // n + (k < 64 % n)
        out.append((at, bits))
        at += bits
    return out


def balls(bits: int, radius: int) -> list[int]:
    """Masks that change 1 to ``radius`` bits."""
    return [sum(1 << i for i in flips) for r in range(1, radius + 1) for flips in combinations(range(bits), r)]


def _linked(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links among ``members`` (distinct) that join all whose chains of links meet: a forest, fewer than there are members."""
    root = np.arange(len(members))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return int(k)

    out = []
    for k in range(1, len(members)):
        near = np.flatnonzero(np.bitwise_count(members[:k] ^ members[k]) <= radius)
        for r, j in {find(j): j for j in near.tolist()}.items():  # one link to each tree that it meets
            out.append((int(members[j].astype(np.int64)), int(members[k].astype(np.int64))))
            root[r] = k
    return out


def links(fps: DataFrame, radius: int = RADIUS, n_segments: int = 3, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (fp): all that connect what is connected.

    Values that are not crowded give every link; crowded ones a forest of theirs.
    """
    each = []
    for k, (shift, bits) in enumerate(segments(n_segments)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND((1 << bits) - 1)
        masks = F.array(*map(F.lit, balls(bits, radius // n_segments)))
        each.append(F.struct(F.lit(k).alias("segment"), value.alias("value"), masks.alias("masks")))
    key = F.col("s.value") * n_segments + F.col("s.segment")
    cut = fps.select("fp", F.explode(F.array(*each)).alias("s"))
    table = cut.select("fp", key.alias("key"))
    # A pair a ball apart would be met from both sides; only values above one's own are asked for, and one's own.
    asked = cut.select("fp", key.alias("key"), F.lit(True).alias("own")).unionByName(
        cut.select("fp", "s.segment", "s.value", F.explode("s.masks").alias("mask"))
        .withColumn("to", F.col("value").bitwiseXOR(F.col("mask").cast("long")))
        .where("to > value")
        .select("fp", (F.col("to") * n_segments + F.col("segment")).alias("key"), F.lit(False).alias("own"))
    )
    crowds = stored(table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowded), "crowded")
    known = table.join(crowds.select("key"), "key", "left_anti")
    met = (
        asked.withColumnRenamed("fp", "a")
        .join(known.select("key", F.col("fp").alias("b")), "key")
        .where((~F.col("own") | (F.col("a") < F.col("b"))) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select("a", "b")
    )
    return met.unionByName(_crowded(asked, crowds, radius, block))


def _crowded(asked: DataFrame, crowds: DataFrame, radius: int, block: int) -> DataFrame:
    """Forests of the fingerprints that ask for a crowded value (its own members do so too), by pairs of blocks."""
    kinds = arrow_schema(asked.sparkSession, "a long, b long")

    def run(table: pa.Table) -> pa.Table:
        members = np.unique(table.column("fp").to_numpy().view(np.uint64))
        found = _linked(members, radius)
        return pa.table([[a for a, _ in found], [b for _, b in found]], schema=kinds)

    there = asked.join(crowds, "key")
    size = F.ceil(F.col("n") / block)
    mine = F.pmod(F.xxhash64("fp"), size)
    dealt = (
        there.select("fp", "key", mine.alias("mine"), F.explode(F.sequence(F.lit(0), size - 1)).alias("other"))
        .select("fp", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )
    return dealt.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, n_segments: int = 3) -> DataFrame:
    """doc_id, fp, component_id of each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that chains of links reach, the own one
    included; null doc_ids are passed over, and a component of only such has none.
    Null and empty texts have fingerprint zero, which links like any other. Repeated
    rows stay. Other columns are not looked at.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    # A node is named by its smallest doc_id, nulls last, so that the smallest node of a component holds the component's id.
    name = F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), "fp")
    named = distinct.select("fp", name.alias("name"))
    ends = links(distinct.select("fp"), radius, n_segments)
    for end in "ab":
        ends = ends.join(named.select(F.col("fp").alias(end), F.col("name").alias(f"node_{end}")), end)
    roots = components(ends, "node_a", "node_b").select(F.col("node.fp").alias("fp"), F.col("root.id").alias("root_id"), F.lit(True).alias("linked"))
    by_fp = distinct.join(roots, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("root_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    # Rows of one fingerprint, such as empty texts, may be very many.
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    salted = by_fp.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return marked.withColumn("salt", salt).join(salted, ["fp", "salt"]).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, n_segments: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id (of repeated such rows, one).

    A component whose doc_ids are all null keeps one of its rows.
    """
    row = fresh(docs, "row_of_table")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    marked = near_duplicates(numbered.select(key.alias("doc_id"), "text"), radius, shingle, n_segments)
    first = marked.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias(row))
    return numbered.join(first, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
