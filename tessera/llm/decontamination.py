"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting for every word of the corpus and serves any query set. It is
cut by documents, as search engines cut theirs: a segment is one row with the posting
lists of a few thousand documents, so building it and searching it need no shuffle and
a very frequent term only ever lengthens lists within a segment. Positions count words
through the whole segment, with a gap between documents that no phrase or proximity
window can bridge. Windows of the query set wait under their term that is rarest in the
corpus; a segment tries those whose rarest term it has. That term's list, moved back by
the term's place in the window, is intersected with the other terms' moved lists,
rarest in the segment first, until it is empty or all have agreed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, row_key, settled, stored, without

#: Words of a segment: bounds the memory of a task whatever a partition holds (a longer document is a segment of its own).
SEGMENT_WORDS = 300_000
#: Bytes of query text that one search carries to every worker; more text goes in blocks.
BLOCK_BYTES = 16 << 20

#: Everything but digits, letters and non-ASCII becomes a blank; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: ``term`` are the segment's words, joined by blanks (no word holds one); ``n_postings`` the lengths of their lists, as
#: little-endian int32; ``gaps`` the lists one after the other, each position less the one before it in its list, as the
#: lowest bytes of all, then the second ones and so on, of which the higher ones are mostly zero and pack well.
INDEX = "segment long, doc_id array<{id}>, first_position array<int>, n_words array<int>, term binary, n_postings binary, gaps binary"


def words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased; null has none."""
    return text.translate(_FOLD).split() if text else []


# ---------------------------------------------------------------- index


def build_index(docs: DataFrame, gap: int = 64) -> DataFrame:
    """Segments of positional postings for all words of ``docs`` (doc_id, text).

    Null and empty texts are documents without words. Repeated rows stay apart.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        n = made = 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                w = words(text)
                held.append((doc_id, w))
                n += len(w) + gap
                if n >= SEGMENT_WORDS:
                    yield _segment(base + made, held, gap)
                    held, n, made = [], 0, made + 1
        if held:
            yield _segment(base + made, held, gap)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        docs.select("doc_id", F.col("text").cast("binary").alias("text")), rows, INDEX.format(id=kind)
    )


def _segment(number: int, held: list[tuple], gap: int) -> dict:
    ids: dict[bytes, int] = {}
    n_words = np.array([len(w) for _, w in held], np.int64)
    first = np.concatenate([[0], np.cumsum(n_words + gap)[:-1]])
    total = int(n_words.sum())
    term = np.fromiter((ids.setdefault(x, len(ids)) for _, w in held for x in w), np.int32, total)
    place = np.arange(total) + np.repeat(first - np.cumsum(n_words) + n_words, n_words)
    counts = np.bincount(term, minlength=len(ids))
    positions = place[np.argsort(term, kind="stable")]
    gaps = np.diff(positions, prepend=0)
    starts = (np.cumsum(counts) - counts)[counts > 0]
    gaps[starts] = positions[starts]
    return {
        "segment": [number],
        "doc_id": [[d for d, _ in held]],
        "first_position": [first.astype(np.int32)],
        "n_words": [n_words.astype(np.int32)],
        "term": [b" ".join(ids)],
        "n_postings": [counts.astype("<i4").tobytes()],
        "gaps": [gaps.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()],
    }


def term_counts(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """Postings that each of ``terms`` has in the index; no more rows than terms come to the driver."""
    sent = index.sparkSession.sparkContext.broadcast(terms)  # within BLOCK_BYTES

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        found: Counter = Counter()
        for b in batches:
            for term, n in zip(b["term"], b["n_postings"], strict=True):
                for t, k in zip(term.split(), np.frombuffer(n, "<i4").tolist(), strict=True):
                    if t in sent.value:
                        found[t] += k
        yield {"term": list(found), "n": list(found.values())}

    per_task = arrow_map(index.select("term", "n_postings"), rows, "term binary, n long", at_once=1)
    counts = {bytes(r["term"]): r["n"] for r in per_task.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    sent.unpersist()
    return counts


# ---------------------------------------------------------------- search


@dataclass
class Segment:
    """A row of the index, of which lists are read as they are asked for."""

    place: dict[bytes, tuple[int, int]]  # where in the gaps a term's list begins and ends
    gaps: np.ndarray
    first: np.ndarray
    n_words: np.ndarray

    @classmethod
    def of(cls, term: bytes, n_postings: bytes, gaps: bytes, first: list[int], n_words: list[int], wanted: Iterable[bytes] | None = None):
        """``wanted``, if given, are the only terms that will be asked for."""
        end = np.cumsum(np.frombuffer(n_postings, "<i4"), dtype=np.int64).tolist()
        terms = term.split()
        keep = range(len(terms)) if wanted is None else [k for k, t in enumerate(terms) if t in wanted]
        place = {terms[k]: (end[k - 1] if k else 0, end[k]) for k in keep}
        planes = np.frombuffer(gaps, np.uint8).reshape(4, -1)
        return cls(place, planes, np.array(first, np.int64), np.array(n_words, np.int64))

    def size(self, term: bytes) -> int:
        a, b = self.place.get(term, (0, 0))
        return b - a

    def postings(self, term: bytes) -> np.ndarray:
        a, b = self.place[term]
        return np.cumsum(np.ascontiguousarray(self.gaps[:, a:b].T).view("<i4").ravel(), dtype=np.int64)

    def phrase(self, terms: tuple[bytes, ...], lists: dict[bytes, np.ndarray]) -> np.ndarray:
        """Where ``terms`` stand one after the other; ``lists`` keeps what has been read."""
        starts = None
        for k in sorted(range(len(terms)), key=lambda k: self.size(terms[k])):
            p = self._list(terms[k], lists)
            if starts is None:
                starts = p - k
            elif len(p):
                at = np.searchsorted(p, starts + k)
                at[at == len(p)] = 0
                starts = starts[p[at] == starts + k]
            if not len(p) or not len(starts):
                return np.zeros(0, np.int64)
        return starts

    def _list(self, term: bytes, lists: dict[bytes, np.ndarray]) -> np.ndarray:
        if term not in lists:
            lists[term] = self.postings(term) if term in self.place else np.zeros(0, np.int64)
        return lists[term]

    def near(self, terms: tuple[bytes, ...], span: int, lists: dict[bytes, np.ndarray]) -> list[tuple[int, int]]:
        """Shortest stretches (first, last position) of at most ``span`` words with every term of ``terms``, in any order."""
        need = sorted(set(terms), key=lambda t: (self.size(t), t))
        anchors = self._list(need[0], lists)
        for t in need[1:]:  # anchors with each term within reach
            p = self._list(t, lists)
            if not len(anchors) or not len(p):
                return []
            at = np.searchsorted(p, anchors)
            reach = np.minimum(np.abs(p[np.minimum(at, len(p) - 1)] - anchors), np.abs(p[np.maximum(at - 1, 0)] - anchors))
            anchors = anchors[reach < span]
        merged = []
        for t in need if len(anchors) else ():
            p = self._list(t, lists)
            low, high = np.searchsorted(p, anchors - span + 1), np.searchsorted(p, anchors + span - 1, side="right")
            merged += [(int(x), t) for x in np.unique(np.concatenate([p[a:b] for a, b in zip(low, high, strict=True)]))]
        merged.sort()
        found, last = [], {}
        for p, t in merged:
            last[t] = p
            if len(last) == len(need) and p - (low := min(last.values())) < span:
                if found and found[-1][0] == low:
                    continue
                found.append((low, p))
        return found

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1


def windows(text: bytes | None, width: int) -> list[tuple[bytes, ...]]:
    """``width`` consecutive words each; fewer words, but not none, are one window."""
    w = words(text)
    if len(w) <= width:
        return [tuple(w)] if w else []
    return [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]


@dataclass
class Block:
    """The windows of some items as places in their words, some fourteen bytes a window; who needs one cuts it out."""

    names: list[str]
    terms: list[bytes]
    words: np.ndarray  # of all items, as numbers of terms
    first: np.ndarray  # where each item's words begin, and where the last one's end
    start: np.ndarray  # of each window, by its rarest term, equal windows next to each other
    length: np.ndarray
    item: np.ndarray
    under: dict[bytes, tuple[int, int]]  # which windows wait under a term

    @classmethod
    def of(cls, items: list[tuple[str, bytes]]) -> Block:
        """The items' words; ``wait`` adds the windows."""
        ids: dict[bytes, int] = {}
        each = [np.array([ids.setdefault(w, len(ids)) for w in words(text)], np.int32) for _, text in items]
        none = np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
        return cls([i for i, _ in items], list(ids), np.concatenate([*each, np.zeros(0, np.int32)]), first, none, none, none, {})

    def wait(self, width: int, counts: dict[bytes, int]) -> Block:
        """The windows (see ``windows``) of which the corpus has every term, each under its term of the least count."""
        order = sorted(range(len(self.terms)), key=lambda k: (counts.get(self.terms[k], -1), self.terms[k]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        absent = sum(t not in counts for t in self.terms)  # those have the least ranks
        r, sizes = rank[self.words], np.diff(self.first)
        long = np.flatnonzero(sizes >= width)
        starts = [self.first[long[k]] + np.arange(sizes[long[k]] - width + 1) for k in range(len(long))]
        start = np.concatenate([*starts, self.first[:-1][(sizes > 0) & (sizes < width)]]).astype(np.int64)
        length = np.minimum(width, self.first[np.searchsorted(self.first, start, side="right")] - start)
        rarest, hashed = np.full(len(start), len(order), np.int64), np.zeros(len(start), np.uint64)
        for j in range(width):
            there = length > j
            at = np.where(there, start + j, 0)
            rarest = np.where(there, np.minimum(rarest, r[at]), rarest)
            hashed = np.where(there, hashed * np.uint64(0x9E3779B97F4A7C15) + self.words[at].astype(np.uint64) + np.uint64(1), hashed)
        by = np.lexsort((start, hashed, rarest))
        by = by[rarest[by] >= absent]
        keys, begins = np.unique(rarest[by], return_index=True)
        ends = [*begins[1:].tolist(), len(by)][: len(keys)]
        under = {self.terms[order[k]]: (a, z) for k, a, z in zip(keys.tolist(), begins.tolist(), ends, strict=True)}
        item = np.searchsorted(self.first, start[by], side="right") - 1
        return Block(self.names, self.terms, self.words, self.first, start[by].astype(np.int32), length[by].astype(np.int16), item.astype(np.int32), under)

    def waiting(self, term: bytes) -> Iterator[tuple[tuple[bytes, ...], list[str]]]:
        """The different windows under ``term``, each with the ids of its items."""
        held, ids = None, set()
        for k in range(*self.under.get(term, (0, 0))):
            at = int(self.start[k])
            w = tuple(self.terms[i] for i in self.words[at : at + int(self.length[k])].tolist())
            if w != held and held is not None:
                yield held, sorted(ids)
                ids = set()
            held = w
            ids.add(self.names[self.item[k]])
        if held is not None:
            yield held, sorted(ids)


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The query set in blocks of at most ``limit`` bytes of text (a longer item is a block), so that each can be sent to all workers."""
    q = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("text")
    ).where("text is not null")
    held, n = [], 0
    for r in q.toLocalIterator():
        held.append((r["item_id"], bytes(r["text"])))
        n += len(r["text"])
        if n >= limit:
            yield held
            held, n = [], 0
    if held:
        yield held


STRETCH = "struct<first:int,last:int>"
HITS = (
    "segment long, ordinal int, doc_id {id}, n_words long, "
    f"hits array<{STRETCH}>, items array<string>, near array<{STRETCH}>, near_items array<string>"
)


def search(index: DataFrame, block: list[tuple[str, bytes]], width: int, span: int | None = None) -> DataFrame:
    """Per document of the index: its word count, the word stretches that matches cover, and the items that match.

    ``hits`` and ``items`` are of exact phrases of ``width`` words (see ``windows``); with
    ``span``, ``near`` and ``near_items`` are of stretches of at most so many words that
    hold all words of a window in any order, else empty.
    """
    read = Block.of(block)
    counts = term_counts(index, set(read.terms)) if read.terms else {}
    sent = index.sparkSession.sparkContext.broadcast((set(counts), read.wait(width, counts)))  # within some ten times BLOCK_BYTES

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        wanted, held = sent.value
        for b in batches:
            for k, number in enumerate(b["segment"]):
                s = Segment.of(*(b[c][k] for c in ("term", "n_postings", "gaps", "first_position", "n_words")), wanted)
                n = len(s.first)
                exact, loose = _Found(s), _Found(s)
                lists: dict[bytes, np.ndarray] = {}
                for t in s.place:
                    for w, ids in held.waiting(t):
                        for p in s.phrase(w, lists).tolist():
                            exact.add(p, p + len(w) - 1, ids)
                        for first, last in s.near(w, span, lists) if span else ():
                            loose.add(first, last, ids)
                yield {
                    "segment": [number] * n,
                    "ordinal": list(range(n)),
                    "doc_id": b["doc_id"][k],
                    "n_words": s.n_words,
                    "hits": exact.stretches(),
                    "items": exact.named(),
                    "near": loose.stretches(),
                    "near_items": loose.named(),
                }

    kind = index.schema["doc_id"].dataType.elementType.simpleString()
    return arrow_map(index, rows, HITS.format(id=kind), at_once=1)


class _Found:
    """Matches of a segment by document."""

    def __init__(self, segment: Segment):
        self.segment = segment
        self.at: dict[int, list[tuple[int, int]]] = {}
        self.items: dict[int, set[str]] = {}

    def add(self, first: int, last: int, ids: list[str]) -> None:
        d = int(self.segment.doc_of(np.array(first)))
        start = int(self.segment.first[d])
        self.at.setdefault(d, []).append((first - start, last - start))
        self.items.setdefault(d, set()).update(ids)

    def stretches(self) -> list[list[dict]]:
        return [[{"first": x, "last": y} for x, y in joined(self.at.get(d, []))] for d in range(len(self.segment.first))]

    def named(self) -> list[list[str]]:
        return [sorted(self.items.get(d, ())) for d in range(len(self.segment.first))]


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching stretches made one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(stretches):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, span: int | None = None) -> DataFrame:
    """How far each document of ``docs`` (doc_id, text) is covered by windows of ``items`` (item_id, text).

    One row per input row: doc_id, n_words, n_hit (words inside any exact match), n_items,
    items_sha256 (of the matching item_ids, as sorted strings, comma-joined; of nothing
    where there are none), contaminated, hits (stretches of word numbers), items; and of
    proximity matches (see ``search``; none without ``span``) near and near_items.
    Null and empty texts have no words and no matches; items without words match
    nothing; a null item_id reads as an empty string; items with the same id count once.
    Repeated rows stay. Other columns are not looked at.
    """
    index = stored(build_index(docs, max(64, width, span or 0)), "postings")
    found: list[DataFrame] = []
    for block in blocks(items):
        if found:  # before the next block is sent, this one's matches are stored
            found[-1] = stored(found[-1], "found")
        found.append(search(index, block, width, span))
    found = _merged(found or [search(index, [], width, span)])
    n_hit = F.coalesce(
        F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + (h["last"] - h["first"] + 1)), F.lit(0)
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "hits",
        "items",
        "near",
        "near_items",
    )


def keep_clean(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) that hold no exact window of ``items``.

    Null and empty texts hold none and stay; a row with a null id is known by its text;
    repeated rows stay or go together; all columns, whatever their names, go through.
    """
    key = row_key(docs)

    def hit() -> DataFrame:
        return decontaminate(docs.select(key.alias("doc_id"), "text"), items, width).where("contaminated").select("doc_id").distinct()

    return without(docs, key, settled(docs.sparkSession, hit, "contaminated"))


def _merged(found: list[DataFrame]) -> DataFrame:
    """Matches of several blocks in one stored index, where a row is known by segment and ordinal."""
    if len(found) == 1:
        return found[0]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    names = [n for n in every.columns if n not in ("segment", "ordinal")]
    first = [F.first(n).alias(n) for n in ("doc_id", "n_words")]
    lists = [F.flatten(F.collect_list(n)).alias(n) for n in names[2:]]
    both = every.groupBy("segment", "ordinal").agg(*first, *lists)
    return both.withColumns(
        {n: _one_by_one(F.sort_array(n)) if n in ("hits", "near") else F.array_distinct(n) for n in names[2:]}
    )


def _one_by_one(stretches: Column) -> Column:
    """Sorted stretches, overlapping and touching ones made one."""
    last = lambda done: F.try_element_at(done, F.lit(-1))
    return F.aggregate(
        stretches,
        F.array().cast(f"array<{STRETCH}>"),
        lambda done, h: F.when(
            (F.size(done) > 0) & (h["first"] <= last(done)["last"] + 1),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["last"], h["last"]).alias("last"))
                ),
            ),
        ).otherwise(F.concat(done, F.array(h))),
    )
