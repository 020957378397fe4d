"""SimHash near-duplicates at a similarity of texts: Jaccard of their sets of five-word shingles, 0.8 or more.

Four bits of 64 hold only closest copies; texts of similarity 0.8 lie some ten bits
apart, beyond any ball that can be enumerated. So fingerprints here are longer: WORDS of
64 bits, cut into segments of 21 bits, of which two such texts share one up to a bit
nearly always (``recall``). As in ``simhash``, a table of segment values is asked for the
Hamming balls around one's own and complete distances are verified. Of a ball, the
values are asked for that change a bit whose vote was close (FLIPS of them): a bit in
which two like texts differ is a close one in either. Then exact sets decide, so that links are right whatever the fingerprints say. Equal sets are one entry,
whatever the number of their texts. Members of a value that very many share are first
held against its smallest one; what that leaves in several components is searched in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, arrow_schema, fresh, only, row_key, settled, stored, without
from tessera.llm.components import components

SHINGLE, LEAST, SEED = 5, 0.8, 42
#: Words of a fingerprint, segments of a word and their bits.
WORDS, PER_WORD, BITS = 5, 3, 21
#: Bits of a segment, those with the closest votes, that are changed one at a time.
FLIPS = 5
#: A segment value with more members is searched in blocks.
CROWDED = 2
#: Shingles of a block of sets, and entries of a block of fingerprints.
BLOCK, ENTRIES = 1 << 18, 4096

_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def differing(least: float) -> float:
    """Share of bits in which two sets of the same size and this Jaccard similarity differ: their angle over pi."""
    return math.acos(2 * least / (1 + least)) / math.pi


def recall(least: float, words: int = WORDS) -> float:
    """How likely such sets meet if whole balls are asked for: some segment differs in a bit at most."""
    p = differing(least)
    meet = (1 - p) ** BITS + BITS * p * (1 - p) ** (BITS - 1)
    return 1 - (1 - meet) ** (words * PER_WORD)


def radius(least: float, bits: int) -> int:
    """The complete distance that sets of this similarity keep within, but for one in a thousand."""
    p = differing(least)
    return math.ceil(bits * p + 3.1 * math.sqrt(bits * p * (1 - p)))


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes, sorted, of the shingles (A-Z lower-cased, white-space words); a text of fewer words is one shingle."""
    import xxhash

    w = text.lower().split() if text else []  # bytes.lower() changes A-Z only
    if not w:
        return np.zeros(0, np.uint64)
    line = b" ".join(w)
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(w) - shingle + 1)
    starts = (ends - sizes)[:n].tolist()
    stops = ends[min(shingle, len(w)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, stops, strict=True)), np.uint64, n))


def fingerprint(hashes: np.ndarray, words: int = WORDS) -> tuple[list[int], list[int]]:
    """Signed words of the SimHash of a set: a bit is set if more than half of the hashes, mixed anew for each word, have it.

    And for each segment the places of the FLIPS bits with the closest votes, five bits each.
    """
    ones = np.zeros(64 * words, np.int64)
    steps = (np.arange(1, words + 1, dtype=np.uint64) * _GOLDEN)[None, :]
    for k in range(0, len(hashes), 255):  # so many ones fit a byte
        x = hashes[k : k + 255, None] + steps
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits.view(np.uint64), axis=0).view(np.uint8)
    margin = np.abs(2 * ones - len(hashes)).reshape(words, 64)[:, : PER_WORD * BITS].reshape(words * PER_WORD, BITS)
    close = np.argsort(margin, axis=1, kind="stable")[:, :FLIPS]
    packed = (close << (5 * np.arange(FLIPS))).sum(1)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8").tolist(), packed.tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two sorted sets; 1 for two empty ones."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def _alike(pairs: DataFrame, texts: DataFrame, least: float, shingle: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts (node, text) are similar enough."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            found: dict[str, list] = {"a": [], "b": []}
            for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"], strict=True):
                if len(known) > 256:
                    known.clear()
                for node, text in ((a, x), (b, y)):
                    if node not in known:
                        known[node] = shingles(text, shingle)
                if similarity(known[a], known[b]) >= least:
                    found["a"].append(a)
                    found["b"].append(b)
            yield found

    # The texts are not renamed before they are joined, so that both joins read the same exchange.
    both = pairs.join(texts.alias("of_a"), F.col("a") == F.col("of_a.node")).select("a", "b", F.col("of_a.text").alias("x"))
    both = both.join(texts.alias("of_b"), F.col("b") == F.col("of_b.node")).select("a", "b", "x", F.col("of_b.text").alias("y"))
    return arrow_map(both, rows, "a long, b long")


def _forest(nodes: list[int], trees: list[int], sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links among ``nodes`` that join all whose chains of similar sets meet, beyond what ``trees`` already joins."""
    root = {t: t for t in trees}

    def find(t: int) -> int:
        while root[t] != t:
            root[t] = root[root[t]]
            t = root[t]
        return t

    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    _, at = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.zeros(at.max() + 1, np.int64)
    out, several = [], False
    for k in range(1, len(nodes)):
        stop = starts[k]
        if not several and find(trees[k]) == find(trees[0]):
            continue
        several = True
        own = at[stop : stop + sizes[k]]
        mine[own] = 1
        shared = np.add.reduceat(mine[at[:stop]], starts[:k])
        mine[own] = 0
        for j in np.flatnonzero(shared / (sizes[:k] + sizes[k] - shared) >= least).tolist():
            if find(trees[j]) != find(trees[k]):
                out.append((nodes[j], nodes[k]))
                root[find(trees[j])] = find(trees[k])
        if len(out) and len({find(t) for t in root}) == 1:
            break
    return out


def _distance(a: Column, b: Column) -> Column:
    """Differing bits of two arrays of words."""
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _dealt(members: DataFrame, size: Column) -> DataFrame:
    """``members`` of each key in pairs of ``size`` blocks (i, j): a member is in all pairs that its block is in."""
    mine = F.pmod(F.xxhash64("node"), size)
    return (
        members.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1)))
        .withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
        .drop("mine", "other")
    )


def _undecided(members: DataFrame, least: float, entries: int) -> DataFrame:
    """Those of ``members`` (key, node, tree, w, and how many ``members`` the key has) that a member of another tree is near."""
    most, kinds = radius(least, 64 * WORDS), arrow_schema(members.sparkSession, "key long, node long")

    def run(table: pa.Table) -> pa.Table:
        tree = table.column("tree").to_numpy()
        w = np.array(table.column("w").to_pylist(), np.int64).view(np.uint64).reshape(len(tree), -1)
        near = np.zeros(len(tree), bool)
        for k in range(len(tree)):
            far = np.bitwise_count(w[k + 1 :] ^ w[k]).sum(1, dtype=np.int64)
            others = np.flatnonzero((far <= most) & (tree[k + 1 :] != tree[k])) + k + 1
            near[others] = True
            near[k] |= len(others) > 0
        rows = table.select(["key", "node"]).filter(pa.array(near))
        return rows.cast(kinds)

    dealt = _dealt(members, F.ceil(F.col("members") / entries)).select("key", "i", "j", "node", "tree", "w")
    return dealt.groupBy("key", "i", "j").applyInArrow(run, "key long, node long").distinct()


def _blocks(members: DataFrame, texts: DataFrame, least: float, shingle: int, block: int) -> DataFrame:
    """Forests of the ``members`` (key, node, n, tree) of each key, by pairs of blocks of ``block`` shingles."""
    kinds = arrow_schema(members.sparkSession, "a long, b long")

    def run(table: pa.Table) -> pa.Table:
        sets = [shingles(t, shingle) for t in table.column("text").to_pylist()]
        found = _forest(table.column("node").to_pylist(), table.column("tree").to_pylist(), sets, least)
        return pa.table([[a for a, _ in found], [b for _, b in found]], schema=kinds)

    total = members.groupBy("key").agg(F.sum("n").alias("total"))
    dealt = _dealt(members.join(total, "key"), F.ceil(F.col("total") / block)).select("key", "i", "j", "node", "tree")
    held = dealt.withColumnRenamed("node", "of_member").join(texts, F.col("of_member") == F.col("node"))
    return held.select("key", "i", "j", "node", "tree", "text").groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def links(
    sets: DataFrame, texts_of: Callable[[DataFrame], DataFrame], least: float = LEAST, shingle: int = SHINGLE, crowded: int = CROWDED, block: int = BLOCK, entries: int = ENTRIES
) -> DataFrame:
    """Links (a, b) among ``sets`` (node, n, w, flips), whose texts (node, text) ``texts_of`` gives for nodes: all that connect what is connected."""
    each = []
    for k in range(WORDS * PER_WORD):
        word, part = divmod(k, PER_WORD)
        value = F.shiftrightunsigned(F.get("w", word), BITS * part).bitwiseAND((1 << BITS) - 1)
        one = F.lit(1).cast("bigint")
        place = lambda i, k=k: F.shiftrightunsigned(F.get("flips", k), 5 * i).bitwiseAND(31).cast("int")
        masks = F.array(F.lit(0).cast("bigint"), *(F.call_function("shiftleft", one, place(i)) for i in range(FLIPS)))
        # Only the word behind the segment's goes to the table, for a first look; the others are joined to what passes.
        each.append(F.struct(F.lit(k).alias("segment"), value.alias("value"), masks.alias("masks"), F.get("w", (word + 1) % WORDS).alias("look")))
    cut = sets.select("node", F.explode(F.array(*each)).alias("s"))
    key = lambda value: (value * len(each) + F.col("s.segment")).alias("key")
    table = cut.select(key(F.col("s.value")), "node", "s.look")
    # Who asks for the own value shows by the sign, which costs no room: of two who do, one is heard.
    by = F.when(F.col("mask") == 0, F.bitwise_not("node")).otherwise(F.col("node")).alias("by")
    asked = cut.select("node", "s", F.explode("s.masks").alias("mask")).select(key(F.col("s.value").bitwiseXOR(F.col("mask"))), by, "s.look")
    crowds = stored(table.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > crowded).select("key"), "crowded")
    # What asks for a crowded value meets a single row of it, without a node, and becomes one of its members.
    known = table.join(crowds, "key", "left_anti").select("key", F.col("node").alias("b"), F.col("look").alias("look_b"))
    known = known.unionByName(crowds.select("key", F.lit(None).cast("bigint").alias("b"), F.lit(None).cast("bigint").alias("look_b")))
    node = F.when(F.col("by") < 0, F.bitwise_not("by")).otherwise(F.col("by"))
    alike = (node != F.col("b")) & ((F.col("by") >= 0) | (node < F.col("b"))) & (F.bit_count(F.col("look").bitwiseXOR(F.col("look_b"))) <= radius(least, 64))
    found = stored(
        asked.join(known, "key").where(F.col("b").isNull() | alike).select(F.when(F.col("b").isNull(), F.col("key")).alias("key"), node.alias("node"), "b"), "met"
    )
    members = found.where("b is null").select("key", "node")
    met = found.where("b is not null").select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    met = stored(_near(met, sets, least), "near_pairs")
    lows = members.groupBy("key").agg(F.min("node").alias("a"))
    crowd_stars = members.join(lows, "key").where("a != node").select("a", F.col("node").alias("b")).distinct()
    stars = met.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").unionByName(_near(crowd_stars, sets, least)).distinct()
    needed = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).unionByName(members.select("node")).distinct()
    texts = stored(texts_of(needed), "candidate_texts")
    first = stored(_alike(stars, texts, least, shingle), "star_links")
    trees = stored(components(first).select("node", F.col("root").alias("tree")), "trees")
    left = met
    for end in "ab":
        tree = trees.select(F.col("node").alias(end), F.col("tree").alias(f"tree_{end}"))
        left = left.join(tree, end, "left").withColumn(f"tree_{end}", F.coalesce(f"tree_{end}", end))
    rest = _alike(left.where("tree_a != tree_b").select("a", "b"), texts, least, shingle)
    grown = members.join(trees, "node", "left").withColumn("tree", F.coalesce("tree", "node"))
    several = grown.groupBy("key").agg(F.min("tree").alias("t0"), F.max("tree").alias("t1"), F.count("*").alias("members"))
    several = several.where("t0 != t1").select("key", "members")
    held = stored(grown.join(several, "key").join(sets, "node").select("key", "members", "node", "tree", "n", "w"), "open_values")
    undecided = held.join(_undecided(held, least, entries), ["key", "node"], "left_semi")
    return first.unionByName(rest).unionByName(_blocks(undecided, texts, least, shingle, block))


def _near(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose complete distance is small enough."""
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("w").alias(f"w_{end}")), end)
    return pairs.where(_distance(F.col("w_a"), F.col("w_b")) <= radius(least, 64 * WORDS)).select("a", "b")


def keep_first(
    docs: DataFrame, least: float = LEAST, shingle: int = SHINGLE, crowded: int = CROWDED, block: int = BLOCK, entries: int = ENTRIES
) -> DataFrame:
    """``docs`` with one row of each component of near copies: the one with the smallest doc_id (of repeated such rows, one).

    A component whose doc_ids are all null keeps one of its rows. Null and empty texts
    are copies of each other. An empty table gives no rows. Other columns, whatever
    their names, go through.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        import xxhash

        for b in batches:
            out: dict[str, list] = {"doc_id": b["doc_id"], "digest": [], "n": [], "w": [], "flips": []}
            for t in b["text"]:
                s = shingles(t, shingle)
                w, flips = fingerprint(s)
                for c, v in (("digest", xxhash.xxh3_128_digest(s.tobytes())), ("n", len(s)), ("w", w), ("flips", flips)):
                    out[c].append(v)
            yield out

    spark, key = docs.sparkSession, row_key(docs)

    def others() -> DataFrame:
        """Keys of the rows that are not the first of a component, and, twice, of the firsts that several rows have."""
        input_ = docs.select(key.alias("doc_id"), F.col("text").cast("binary").alias("text"))
        kind = input_.schema["doc_id"].dataType.simpleString()
        marked = stored(arrow_map(input_, rows, f"doc_id {kind}, digest binary, n long, w array<long>, flips array<long>"), "marked")
        once = marked.groupBy("digest").agg(F.min_by(F.struct("doc_id", "n", "w", "flips"), "doc_id").alias("s")).select("s.*")
        sets = stored(once.withColumn("node", F.monotonically_increasing_id()), "sets")
        keys = marked.groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))

        def texts(nodes: DataFrame) -> DataFrame:
            wanted = stored(sets.join(nodes, "node").select("doc_id", "node"), "candidate_keys")
            found = only(input_, F.col("doc_id"), wanted.select("doc_id")).groupBy("doc_id").agg(F.first("text").alias("text"))
            return found.join(wanted, "doc_id").select("node", "text")

        roots = components(links(sets.where("n > 0"), texts, least, shingle, crowded, block, entries))
        rooted = sets.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        first = rooted.groupBy("root").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("first"))
        told = keys.groupBy("doc_id").agg(F.sum("rows").alias("rows")).join(first, "doc_id", "left")
        return told.where("first IS NULL OR rows > 1").select("doc_id", F.coalesce("first", F.lit(False)).alias("first"))

    gone = settled(spark, others, "gone")
    kept = without(docs, key, gone.select("doc_id"))
    # Of rows that agree in doc_id and text one is taken, whichever.
    of, whole = fresh(docs, "key_of_row"), fresh(docs, "whole_row")
    again = only(docs, key, gone.where("first").select("doc_id")).select(key.alias(of), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(whole))
    return kept.unionAll(again.groupBy(of).agg(F.first(whole).alias(whole)).select(f"{whole}.*"))
