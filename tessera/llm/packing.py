"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

The plan is made over the histogram of piece lengths (at most ``capacity`` rows,
whatever the corpus), never over pieces. An index hashes the sums of one, two and three
lengths; combinations that fill a gap exactly are consumed as often as their counts
allow, and what is left goes best-fit. The plan comes out as runs
("this pattern, so many times"); each run empties a length or closes a bin, so
the number of runs is bounded by the capacity too, and their broadcast with it.
Pieces find their place by (length, rank among equal lengths).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, stored

CAPACITY = 2048

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, part int, rank long"


#: Runs of blanks or of anything else up to this long are tiktoken's; longer ones go to ``tokenizers``: there tiktoken's
#: pattern runs out of stack (blanks) or its merging takes the square of the run (others).
LONGEST_RUN = 1999
# Possessive: no run is looked at twice.
_SHORT_RUNS = re.compile(r"(?:\s{1,%d}+(?!\s)|\S{1,%d}+(?!\S))*+" % (LONGEST_RUN, LONGEST_RUN))


class ByteBpe:
    """The byte-level BPE of a ``tokenizers`` JSON file; texts give the ids that ``tokenizers`` gives by default (the
    special string becomes its id).

    tiktoken, four times as fast, encodes from the same vocabulary; texts with a very long
    run of blanks or of anything else go to ``tokenizers`` itself. Tests hold the two against each other.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {"<|endoftext|>": len(ranks)}
        self._own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._slow = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

    def __call__(self, text: str) -> list[int]:
        if not _SHORT_RUNS.fullmatch(text):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._own.encode(text, allowed_special="all")


_TOKENIZERS: dict[str, ByteBpe] = {}


def tokenizer(name: str) -> ByteBpe:
    """One per worker process."""
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = ByteBpe(name)
    return _TOKENIZERS[name]


# ---------------------------------------------------------------- the plan


class Sums:
    """Sums of two and of three of the lengths, each hashed to the combinations that give it, largest members first.

    A combination is kept by its largest member: a pair's other one is the difference, a
    triple's other two are a pair of the difference. Counts only ever go down, so a
    combination that they no longer allow is dropped when it is met: over a whole plan
    each is dropped once.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        lengths = np.flatnonzero(counts)
        self.pairs = self._hashed(lengths, counts > 0, 2)
        sums = np.zeros(len(counts), bool)
        sums[list(self.pairs)] = True
        self.triples = self._hashed(lengths, sums, 3)

    @staticmethod
    def _hashed(lengths: np.ndarray, rest: np.ndarray, members: int) -> dict[int, array]:
        """The largest members by total, rising; ``rest`` says which sums the others may have. Four bytes each: there are some millions."""
        found = {}
        for total in range(1, len(rest)):
            tops = lengths[(lengths <= total) & (lengths * members >= total)]  # the largest is no less than its share
            if len(tops := tops[rest[total - tops]]):
                found[total] = array("i", tops.astype(np.intc).tobytes())
        return found

    def _allows(self, lengths: tuple[int, ...], held: tuple[int, ...] = ()) -> bool:
        return all(self.counts[x] - held.count(x) >= lengths.count(x) for x in lengths)

    def pair(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        """The pair of this sum with the largest member, without the pieces ``held``."""
        tops = self.pairs.get(total, [])
        for k in reversed(range(len(tops))):
            found = (tops[k], total - tops[k])
            if not self._allows(found):
                del tops[k]
            elif self._allows(found, held):
                return found
        return None

    def triple(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        tops = self.triples.get(total, [])
        for k in reversed(range(len(tops))):
            a = tops[k]
            if not self._allows((a,)) or not self.pair(total - a):
                del tops[k]
            elif self._allows((a,), held) and (rest := self.pair(total - a, (*held, a))):
                return (a, *rest)
        return None

    def single(self, total: int, held: tuple[int, ...] = ()) -> tuple[int, ...] | None:
        return (total,) if 0 < total < len(self.counts) and self._allows((total,), held) else None

    def filling(self, gap: int, held: tuple[int, ...]) -> tuple[int, ...] | None:
        """A single length, a pair or a triple that fills ``gap`` exactly and holds the largest length that fits it, without the pieces ``held``."""
        there = [x for x in np.flatnonzero(self.counts[: gap + 1])[-len(held) - 1 :].tolist() if self._allows((x,), held)]
        if not there:
            return None
        for find in (self.single, self.pair, self.triple):
            if (found := find(gap, held)) and found[0] == there[-1]:
                return found
        return None


def _times(counts: np.ndarray, lengths: list[int]) -> int:
    return min(int(counts[k]) // n for k, n in Counter(lengths).items())


def _take(counts: np.ndarray, lengths: list[int], times: int) -> None:
    for k, n in Counter(lengths).items():
        counts[k] -= n * times


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Runs (times, lengths of the pieces of one sequence) that use up the histogram.

    Combinations that the index of sums names for what a piece leaves of a sequence are consumed first, the residuals
    go best-fit. Combinations use up small pieces, which residuals may need: they are given back from the last one
    on, by halves, as long as the whole then needs fewer sequences, so it never needs more than best-fit alone.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for k, n in histogram.items():
        if not 0 < k <= capacity:
            raise ValueError(f"no piece of {k} fits a sequence of {capacity}")
        counts[k] += n
    consumed = _combinations(counts.copy(), capacity)
    best: list[tuple[int, list[int]]] = []
    keep = len(consumed)
    while True:
        left = counts.copy()
        for times, lengths in consumed[:keep]:
            _take(left, lengths, times)
        whole = consumed[:keep] + _complements(left, capacity) + _fit(left, capacity)
        if not best or sum(n for n, _ in whole) < sum(n for n, _ in best):
            best = whole
        if not keep:
            return best
        keep //= 2


def _combinations(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Sequences filled exactly by a piece and one, two or three others, for each piece in turn, the longest first.

    Only combinations that hold the largest piece that would fit are taken: others would spend small pieces where a
    larger one finds room.
    """
    runs, sums = [], Sums(counts)
    for opener in range(capacity - 1, 0, -1):
        while counts[opener] and (rest := sums.filling(capacity - opener, (opener,))):
            lengths = [opener, *rest]
            runs.append((times := _times(counts, lengths), lengths))
            _take(counts, lengths, times)
    return runs


def _complements(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Whole sequences, and those of two pieces that fill one exactly."""
    runs = [(int(counts[capacity]), [capacity])] if counts[capacity] else []
    counts[capacity] = 0
    for opener in range(capacity - 1, 0, -1):
        lengths = [opener, capacity - opener]
        if counts[opener] and (times := _times(counts, lengths)):
            runs.append((times, lengths))
            _take(counts, lengths, times)
    return runs


def _fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Each length in turn, longest first, into the smallest gaps that it fits."""
    by_gap: list[list[tuple[int, list[int]]]] = [[] for _ in range(capacity + 1)]
    gaps = np.zeros(capacity + 1, bool)

    def put(bins: int, held: list[int], gap: int) -> None:
        if bins:
            by_gap[gap].append((bins, held))
            gaps[gap] = True

    def fill(gap: int, lengths: list[int]) -> None:
        bins, held = by_gap[gap].pop()
        gaps[gap] = bool(by_gap[gap])
        times = min(bins, _times(counts, lengths))
        _take(counts, lengths, times)
        put(bins - times, held, gap)
        put(times, held + lengths, gap - sum(lengths))

    for length in range(capacity, 0, -1):
        while counts[length] and gaps[length]:
            fill(length, [length])
        n = int(counts[length])
        counts[length] = 0
        while n:
            gap = length + int(gaps[length:].argmax())
            if gaps[gap]:
                bins, held = by_gap[gap].pop()
                gaps[gap] = bool(by_gap[gap])
            else:
                gap, held, bins = capacity, [], -(-n // (capacity // length))
            k = gap // length
            full = min(bins, n // k)
            put(full, held + [length] * k, gap - k * length)
            n, bins = n - full * k, bins - full
            if bins and n:  # fewer than k are left
                put(1, held + [length] * n, gap - n * length)
                n, bins = 0, bins - 1
            if held:
                put(bins, held, gap)
    return [b for at in by_gap for b in at]


def places(runs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, per sequence, first sequence, first offset) of each run's lengths."""
    used: Counter = Counter()
    out, sequence = [], 0
    for times, lengths in runs:
        offset = 0
        for length, n in sorted(Counter(lengths).items(), reverse=True):
            out.append((length, used[length], used[length] + n * times, n, sequence, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    return out


# ---------------------------------------------------------------- the operator


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter than the capacity."""
    first = n if n <= capacity else n % capacity
    return [(0, first)] * bool(first) + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = "byte_bpe_50k", end_id: int = 0) -> DataFrame:
    """The documents' pieces, each with its rank among equal lengths of its partition."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        encode, part, seen = tokenizer(name), TaskContext.get().partitionId(), Counter()
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "rank")}
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encode(text) if text else []
                ids.append(end_id)
                raw = np.array(ids, "<u4")
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(raw[start : start + n].tobytes())
                    for c, v in zip(out, (doc_id, k, start, n, crc, seen[n]), strict=True):
                        out[c].append(v)
                    seen[n] += 1
            yield out | {"part": [part] * len(out["piece"])}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), rows, PIECES.format(id=kind))


def pack(docs: DataFrame, capacity: int = CAPACITY, name: str = "byte_bpe_50k") -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their sequence_id and offset.

    A document is its token ids and one id 0; a null or empty text is that id alone.
    Repeated rows and repeated or null doc_ids are documents of their own. An empty
    table gives no rows. Other columns of ``docs`` are not looked at.
    Shuffled are lengths and ranks, some fifty bytes a piece; tokens never are.
    """
    spark = docs.sparkSession
    found = stored(pieces(docs, capacity, name), "pieces")
    per_part = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = spark.createDataFrame(
        places(plan(histogram, capacity)),
        "length long, lo long, hi long, per long, first_sequence long, first_offset long",
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(base, ["part", "length"]).withColumn("at", F.col("base") + F.col("rank"))
    w = where.withColumnRenamed("length", "of_length")
    nth = F.col("at") - F.col("lo")
    return (
        ranked.join(
            F.broadcast(w),  # bounded by the capacity
            (F.col("length") == F.col("of_length")) & (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
            (F.col("first_offset") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"),
        )
    )
