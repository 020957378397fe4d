"""Sharding by histogram sort.

Rows are ordered by a 192-bit key (hash of the text, hash of the id, a number of the
row), so equal texts lie together and yet any group can be cut. Candidate boundaries
split the key range evenly; the exact bytes below each are counted across all
partitions, the intervals that hold a splitter are probed anew, 4096-fold finer, and so
on until each splitter is within tolerance or its interval is a single row. Only then
are rows exchanged, once, in cells: ranges of keys with nearly as many rows each, which
are found the same way and cut through a very frequent text as through any other.

Everything is a DataFrame expression; the driver sees at most 4096 counts for each
splitter and round.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

SHARDS = 24
WORDS = ("k1", "k2", "k3")
WORD_BITS, KEY_BITS, STEP = 64, 192, 12
#: Ranges of keys that are sorted each on its own, and the rows from which there are more of them.
CELLS, MOST_ROWS = 1024, 1 << 20


@dataclass
class Interval:
    """Keys whose first ``depth`` bits are ``prefix``, and the bytes of all keys below them."""

    prefix: int = 0
    depth: int = 0
    below: int = 0

    @property
    def start(self) -> int:
        return self.prefix << (KEY_BITS - self.depth)

    @property
    def end(self) -> int:
        return (self.prefix + 1) << (KEY_BITS - self.depth)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key's three words, each a long whose signed order is the key's."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("k2"),
        (F.monotonically_increasing_id() + F.lit(-(1 << 63))).alias("k3"),
    )


def _bits(depth: int, n: int) -> Column:
    """Bits ``depth`` to ``depth + n`` of the key, which lie in one word."""
    word, at = divmod(depth, WORD_BITS)
    ordered = F.col(WORDS[word]).bitwiseXOR(F.lit(-(1 << 63)))
    return F.shiftrightunsigned(ordered, WORD_BITS - at - n).bitwiseAND((1 << n) - 1)


def _signed(word: int) -> int:
    return word - (1 << 63)


def _within(i: Interval) -> Column:
    """Whether a row's key is in the interval."""
    found = F.lit(True)
    for k, name in enumerate(WORDS):
        depth = min(max(i.depth - k * WORD_BITS, 0), WORD_BITS)
        if not depth:
            break
        part = (i.prefix >> (i.depth - k * WORD_BITS - depth)) & ((1 << depth) - 1)
        low = part << (WORD_BITS - depth)
        high = low + (1 << (WORD_BITS - depth)) - 1
        found = found & F.col(name).between(F.lit(_signed(low)), F.lit(_signed(high)))
    return found


def _at_or_after(key: int) -> Column:
    """Whether a row's key is at or above ``key``."""
    if key >= 1 << KEY_BITS:
        return F.lit(False)
    words = [_signed((key >> (KEY_BITS - (k + 1) * WORD_BITS)) & ((1 << WORD_BITS) - 1)) for k in range(3)]
    a, b, c = (F.col(n) for n in WORDS)
    return (a > words[0]) | ((a == words[0]) & ((b > words[1]) | ((b == words[1]) & (c >= words[2]))))


def _step(depth: int, first: int) -> int:
    """Bits of the next round: ``first`` in the first one, else STEP, within a word."""
    return min(first if not depth else STEP, WORD_BITS - depth % WORD_BITS)


def _counts(rows: DataFrame, intervals: list[Interval], weight: Column, n: int) -> list[list[tuple[int, int, int, int, int]]]:
    """For each interval: (next ``n`` bits, weight, rows, least and greatest value of the word they are in), in order."""
    depth = intervals[0].depth
    which = F.lit(None).cast("int")
    for k, i in enumerate(intervals):
        which = F.when(_within(i), k).otherwise(which)
    word = F.col(WORDS[depth // WORD_BITS])
    found = (
        rows.select(which.alias("i"), _bits(depth, n).alias("bin"), weight.alias("weight"), word.alias("word"))
        .where("i is not null")
        .groupBy("i", "bin")
        .agg(F.sum("weight").alias("size"), F.count("*").alias("n"), F.min("word").alias("low"), F.max("word").alias("high"))
    )
    out: list[list] = [[] for _ in intervals]
    for r in found.collect():  # at most 4096 for each interval, in the first round four for each share
        out[r["i"]].append((r["bin"], r["size"], r["n"], r["low"], r["high"]))
    return [sorted(v) for v in out]


def splitters(rows: DataFrame, shares: int, tolerance: float, weight: Column | None = None) -> list[int]:
    """Keys from which each further share begins, with bytes (or ``weight``) as equal as whole rows allow or ``tolerance`` asks."""
    weight = F.col("size") if weight is None else weight
    total = rows.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    targets = [total * k / shares for k in range(1, shares)]
    allowed = tolerance * total / shares
    first = max(STEP, (4 * shares - 1).bit_length())
    found: dict[int, int] = {}
    active = {k: Interval() for k in range(len(targets))} if total else {}
    while active:
        depth = min(i.depth for i in active.values())
        level = {k: i for k, i in active.items() if i.depth == depth}
        order = {i.prefix: n for n, i in enumerate({i.prefix: i for i in level.values()}.values())}
        n = _step(depth, first)
        counts = _counts(rows, [Interval(p, depth) for p in order], weight, n)
        sums = [list(accumulate(size for _, size, *_ in c)) for c in counts]
        for k, i in level.items():
            at = order[i.prefix]
            j = min(bisect_right(sums[at], targets[k] - i.below), len(sums[at]) - 1)
            value, size, count, low, high = counts[at][j]
            below = i.below + sums[at][j] - size
            inner = Interval((i.prefix << n) | value, i.depth + n, below)
            to_start, to_end = abs(targets[k] - below), abs(below + size - targets[k])
            if count == 1 or min(to_start, to_end) <= allowed or inner.depth == KEY_BITS:
                found[k] = inner.start if to_start <= to_end else inner.end
                del active[k]
                continue
            if low == high and inner.depth % WORD_BITS:  # one value of this word: go on with the next
                rest = WORD_BITS - inner.depth % WORD_BITS
                word = low + (1 << 63)
                inner = Interval((inner.prefix << rest) | (word & ((1 << rest) - 1)), inner.depth + rest, below)
            active[k] = inner
    return [found[k] for k in sorted(found)]


def _listed(numbers: list[int]) -> Column:
    """A constant array, without an expression for each of its elements."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def cell_of(starts: list[int]) -> Column:
    """How many of the keys ``starts``, which are in order, are at or below a row's key.

    The key's first bits say how many lie below all keys that begin so; only keys that
    begin like a very frequent text have starts among them, which are then compared.
    """
    bits = max(STEP, (4 * len(starts)).bit_length())
    shift = KEY_BITS - bits
    first = [bisect_left(starts, b << shift) for b in range((1 << bits) + 1)]
    first = [n + (n < len(starts) and starts[n] == b << shift) for b, n in enumerate(first)]  # a start at the bin's edge is below all of it
    within = [bisect_left(starts, (b + 1) << shift) for b in range(1 << bits)]
    words = [_listed([_signed((x >> (KEY_BITS - (k + 1) * WORD_BITS)) & ((1 << WORD_BITS) - 1)) for x in starts] or [0]) for k in range(3)]
    a, b, c = (F.col(w) for w in WORDS)

    def reached(i: Column) -> Column:
        x, y, z = (F.get(w, i) for w in words)
        return (a > x) | ((a == x) & ((b > y) | ((b == y) & (c >= z))))

    bin_ = _bits(0, bits).cast("int")
    low, high = F.get(_listed(first[:-1]), bin_).cast("int"), F.get(_listed(within), bin_).cast("int")
    inside = F.size(F.filter(F.sequence(low, high - 1), reached))
    return F.when(high > low, low + inside).otherwise(low)


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = 1e-6, least_cell: int = 256) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in a shard and a slot there, shards nearly equal in bytes.

    Gives doc_id, size (UTF-8 bytes of the text and 8; null has none), text_crc32, law
    ("bytes"), shard, slot (gapless from 0 in each shard, in the order of the keys),
    grown_shard (null). Equal texts are neighbours, in as few shards as equal sizes
    allow, however many they are. Repeated rows, and rows with null ids, have keys of
    their own by their number. Fewer rows than shards leave some shards empty; no rows
    give none. Other columns are not looked at. Slots are counted in 1024 cells of
    nearly as many rows each, more where those would hold over 2**20 rows and fewer
    where they would hold under ``least_cell``.
    """
    rows = stored(keyed(docs), "keys")
    which = F.lit(0)
    for key in splitters(rows, shards, tolerance):
        which = which + _at_or_after(key).cast("int")
    n = rows.count()
    starts = splitters(rows, max(1, min(n // least_cell, max(CELLS, n // MOST_ROWS))), 0.5, F.lit(1))
    placed = rows.withColumn("shard", which.cast("int")).withColumn("cell", cell_of(sorted(set(starts))))
    sizes = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    within = Window.partitionBy("shard", "cell").orderBy(*WORDS)
    ranked = placed.withColumn("nth", F.row_number().over(within))
    return (
        ranked.join(F.broadcast(first), ["shard", "cell"])  # a row for each cell and one more for each splitter
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first_slot") + F.col("nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
