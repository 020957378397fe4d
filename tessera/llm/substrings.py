"""Exact substring dedup with difference-cover anchors.

A window is ``width`` consecutive words. Only shorter anchor windows are hashed
everywhere, and those only at positions in their document that fall on a difference cover
modulo its period: for any two positions there is a shift, smaller than the period, that
brings both onto the cover, so two equal windows always share an anchor at the same place
in them. (Positions in the chunk would not do: each pass meets a chunk's documents in the
order in which they are fetched, which may be another one each time.) Anchors that occur once end the matter for all windows around them. Where an
anchor occurs again, it is extended: all whole windows that hold it are compared by
96-bit digests.

Documents are dealt into chunks by a hash of their content, once; that exchange
serves all three passes. A chunk hands on each digest once, however often it holds it,
so a passage that a third of all documents share is a row of each chunk, not of each
document. Digests travel as one binary value for each chunk and bucket, and what comes
back to a chunk is what was found elsewhere too.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, partitions

WIDTH = 35
#: A perfect difference cover: every difference modulo 21 is that of two of its members.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Bytes of text of a chunk, and of digests of a bucket, at least and at most: what a task holds at once. They grow with
#: the corpus, so that what a chunk sends to a bucket stays worth a row.
CHUNK_BYTES, BUCKET_BYTES = (4 << 20, 32 << 20), (8 << 20, 64 << 20)

_U = np.uint64
_BASE, _BASE_INVERSE = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BASE2, _BASE2_INVERSE = _U(0xC2B2AE3D27D4EB4F), _U(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        _POWERS[int(base)] = held = np.cumprod(held, dtype=np.uint64)
    return held[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A second, unrelated hash of each hash."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _rolled(hashes: np.ndarray, width: int, base: np.uint64, inverse: np.uint64) -> np.ndarray:
    """A digest of each ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([[_U(0)], np.cumsum(hashes * _powers(base, len(hashes)), dtype=np.uint64)])
    return _mixed((sums[width:] - sums[:-width]) * _powers(inverse, n))


def _word_hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    _, offsets, raw = words.buffers()
    cuts = np.frombuffer(offsets, np.int64)[: len(words) + 1].tolist()
    raw = raw.to_pybytes()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(raw[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)), np.uint64, len(words))


class Chunk:
    """The words of a chunk's documents, one after the other."""

    def __init__(self, texts: list[bytes | None], width: int, period: int, cover: tuple[int, ...]):
        self.texts = [t or b"" for t in texts]
        line = np.frombuffer(b" ".join([*self.texts, b""]), np.uint8)
        space = _SPACE[line]
        edge = np.flatnonzero(np.diff(space, prepend=True))  # a word starts, a word ends, and so on
        starts, ends = edge[::2], edge[1::2]
        docs = np.cumsum([0] + [len(t) + 1 for t in self.texts])
        self.first = np.searchsorted(starts, docs)
        self.n = np.diff(self.first)
        total = len(starts)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(line[~space])]
        named = pa.Array.from_buffers(pa.large_binary(), total, buffers).dictionary_encode()
        self.hashes = _word_hashes(named.dictionary)[named.indices.to_numpy()] if total else np.zeros(0, np.uint64)
        self.width, self.period, self.cover = width, period, cover
        ends = np.repeat(self.first[1:], self.n)  # where the document of each word ends
        self.left = ends - np.arange(total)  # words from here to that end
        self.place = np.arange(total) - np.repeat(self.first[:-1], self.n)  # in its document, whatever the order of documents

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions on the cover with a whole anchor in a document that has a whole window, and the anchors' digests."""
        length = self.width - self.period + 1
        digests = _rolled(self.hashes, length, _BASE, _BASE_INVERSE)
        on = np.zeros(self.period, bool)
        on[list(self.cover)] = True
        at = np.arange(len(digests))
        long_enough = np.repeat(self.n >= self.width, self.n)[: len(digests)]
        keep = on[self.place[: len(digests)] % self.period] & (self.left[: len(digests)] >= length) & long_enough
        return at[keep], digests[keep]

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the whole windows that hold one of the anchors at ``anchors``."""
        total = len(self.hashes)
        if total < self.width or not len(anchors):
            return np.zeros(0, np.int64)
        marks = np.zeros(total + 1, np.int64)
        marks[anchors + 1] = 1
        sums = np.cumsum(marks)
        starts = np.arange(total - self.width + 1)
        near = sums[np.minimum(starts + self.period, total)] > sums[starts]
        return starts[near & (self.left[: len(starts)] >= self.width)]

    def digests(self, starts: np.ndarray) -> Digests:
        """96 bits of each window."""
        if not len(starts):
            return Digests(np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        a = _rolled(self.hashes, self.width, _BASE, _BASE_INVERSE)[starts]
        b = _rolled(_mixed(self.hashes), self.width, _BASE2, _BASE2_INVERSE)[starts]
        return Digests(a, (b >> _U(32)).astype(np.uint32))


@dataclass
class Digests:
    """Two parts of digests, side by side: 64 bits, and 32 bits where windows are told apart for good."""

    a: np.ndarray
    b: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.a)

    def at(self, where: np.ndarray) -> Digests:
        return Digests(self.a[where], None if self.b is None else self.b[where])

    def distinct(self) -> tuple[Digests, np.ndarray, np.ndarray]:
        """The distinct ones in order, how often each occurs, and which of them each digest is."""
        order = np.argsort(self.a, kind="stable")
        s = self.at(order)
        new = s.a[1:] != s.a[:-1]
        if s.b is not None and not new.all():
            differ = s.b[1:] != s.b[:-1]
            if (differ & ~new).any():  # equal in the first part only
                order = np.lexsort((self.b, self.a))
                s = self.at(order)
                new = (s.a[1:] != s.a[:-1]) | (s.b[1:] != s.b[:-1])
        first = np.concatenate([np.ones(min(len(s), 1), bool), new])
        starts = np.flatnonzero(first)
        which = np.empty(len(s), np.int64)
        which[order] = np.cumsum(first) - 1
        return s.at(starts), np.diff(np.append(starts, len(s))), which

    def pack(self) -> bytes:
        return self.a.tobytes() + (b"" if self.b is None else self.b.tobytes())

    @classmethod
    def unpack(cls, raw: list[bytes], wide: bool) -> Digests:
        if not wide:
            return cls(np.frombuffer(b"".join(raw), np.uint64))
        n = [len(x) // 12 for x in raw]
        a = [np.frombuffer(x, np.uint64, k) for x, k in zip(raw, n, strict=True)]
        b = [np.frombuffer(x, np.uint32, k, 8 * k) for x, k in zip(raw, n, strict=True)]
        return cls(np.concatenate(a), np.concatenate(b))


def _dealt(chunk: int, digests: Digests, buckets: int, schema: pa.Schema) -> pa.Table:
    """Distinct digests, in order, cut into buckets by their first bits; a row for each bucket that gets any."""
    if not len(digests):
        return schema.empty_table()
    bucket = ((digests.a >> _U(32)) * _U(buckets)) >> _U(32)
    full, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts[1:], len(bucket))
    return pa.table(
        [
            pa.array(np.full(len(full), chunk), pa.int32()),
            pa.array(full.astype(np.int64), pa.int32()),
            pa.array([digests.at(slice(i, j)).pack() for i, j in zip(starts, ends, strict=True)], pa.binary()),
        ],
        schema=schema,
    )


_ROWS = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("found", pa.binary())])
_ROWS_DDL = "chunk int, bucket int, found binary"


def _elsewhere(wide: bool):
    """For each chunk of a bucket, the first parts of those of its digests that another chunk has too."""

    def run(table: pa.Table) -> pa.Table:
        chunks, raw = table.column("chunk").to_pylist(), table.column("found").to_pylist()
        sizes = np.array([len(x) for x in raw]) // (12 if wide else 8)
        every = Digests.unpack(raw, wide)
        _, counts, which = every.distinct()
        shared = counts[which] > 1  # a chunk names a digest once
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        back = [every.a[i:j][shared[i:j]].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        out = [(c, x) for c, x in zip(chunks, back, strict=True) if x]
        return pa.table([[c for c, _ in out], [0] * len(out), [x for _, x in out]], schema=_ROWS)

    return run


def _joined(table: pa.Table) -> np.ndarray:
    """All digests that came back to a chunk, in order."""
    return np.sort(np.frombuffer(b"".join(table.column("found").to_pylist()), np.uint64))


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def repeated_words(
    docs: DataFrame,
    width: int = WIDTH,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
    chunk_bytes: tuple[int, int] = CHUNK_BYTES,
    bucket_bytes: tuple[int, int] = BUCKET_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) without the words that repeated windows cover.

    Gives doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one
    blank) and, ``with_text``, the kept words so joined. A window is repeated if its
    word sequence starts anywhere else, in the same document or another; all are judged
    on the input. Null and empty texts, and texts shorter than a window, lose nothing.
    Repeated rows count as often as they are there, so whole copies lose all they can.
    Other columns are not looked at.
    """
    if not 0 < period <= width or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover must be a difference cover of a period that is no longer than the window")
    spark = docs.sparkSession
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    least = partitions(spark)

    def parts(size: int, bounds: tuple[int, int]) -> int:
        each = min(max(size // 10_000, bounds[0]), bounds[1])
        return max(least, -(-size // each))

    chunks = parts(n_bytes, chunk_bytes)
    buckets = parts(n_bytes * len(cover) // period, bucket_bytes)  # eight bytes for a word on the cover, as for some eight of text
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"),
        "doc_id",
        F.col("text").cast("binary").alias("text"),
    ).groupBy("chunk")

    def chunk_of(table: pa.Table) -> Chunk:
        return Chunk(table.column("text").to_pylist(), width, period, cover)

    def send_anchors(table: pa.Table) -> pa.Table:
        _, digests = chunk_of(table).anchors()
        distinct = Digests(np.unique(digests))
        return _dealt(table.column("chunk")[0].as_py(), distinct, buckets, _ROWS)

    def candidates(c: Chunk, back: pa.Table) -> np.ndarray:
        at, digests = c.anchors()
        _, counts, which = Digests(digests).distinct()
        return c.around(at[(counts[which] > 1) | _in(digests, _joined(back))])

    def send_windows(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _ROWS.empty_table()
        c = chunk_of(table)
        distinct, _, _ = c.digests(candidates(c, back)).distinct()
        return _dealt(table.column("chunk")[0].as_py(), distinct, buckets, _ROWS)

    out_ddl = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    out_schema = arrow_schema(spark, out_ddl)

    def remove(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out_schema.empty_table()
        c = chunk_of(table)
        tags = np.array(back.column("bucket").to_pylist(), np.int64)
        starts = candidates(c, back.filter(pa.array(tags == 0)) if len(tags) else back)
        digests = c.digests(starts)
        _, counts, which = digests.distinct()
        windows = _joined(back.filter(pa.array(tags == 1)) if len(tags) else back)
        gone = starts[(counts[which] > 1) | _in(digests.a, windows)]
        marks = np.zeros(len(c.hashes) + 1, np.int64)
        np.add.at(marks, gone, 1)
        np.add.at(marks, gone + width, -1)
        covered = np.cumsum(marks)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(covered)])
        n_removed = removed[c.first[1:]] - removed[c.first[:-1]]
        kept = []
        for k, text in enumerate(c.texts):
            ws = text.split()
            if n_removed[k]:
                stay = ~covered[c.first[k] : c.first[k + 1]]
                ws = [w for w, s in zip(ws, stay.tolist(), strict=True) if s]
            kept.append(b" ".join(ws))
        columns = [
            table.column("doc_id").combine_chunks(),
            pa.array(c.n),
            pa.array(n_removed),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
        ]
        return pa.table(columns + [pa.array([x.decode() for x in kept])] * with_text, schema=out_schema)

    sent = dealt.applyInArrow(send_anchors, _ROWS_DDL)
    anchors = sent.groupBy("bucket").applyInArrow(_elsewhere(False), _ROWS_DDL)
    extended = dealt.cogroup(anchors.groupBy("chunk")).applyInArrow(send_windows, _ROWS_DDL)
    windows = extended.groupBy("bucket").applyInArrow(_elsewhere(True), _ROWS_DDL)
    both = anchors.unionByName(windows.withColumn("bucket", F.lit(1)))
    return dealt.cogroup(both.groupBy("chunk")).applyInArrow(remove, out_ddl)
