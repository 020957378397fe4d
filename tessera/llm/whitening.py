"""Embedding whitening from exact integer products (digit-slice GEMM).

Entries become integers, so a covariance can be exact: each task cuts its centred
integers into limbs so small that a float64 matrix product of two limbs has no rounding,
puts the products together as big integers, and the tasks' integers are added. Only the
finished covariance is rounded, once, before its eigenvectors are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, fresh, small_batches, stored

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries beyond this, scaled, count as not finite: their integers would not fit a long.
LARGEST = 2.0**61
#: Bits of a limb; a product of two limbs, summed over 2**(53 - 2 * LIMB) rows, is exact in float64.
LIMB = 10
#: Bits of a digit when big integers travel between tasks: sums of 2**33 digits fit a long.
DIGIT = 30
#: Partial sums that meet in a task.
FAN = 64
#: An eigenvalue below this share of the largest, times the dimensions, is rounding: there is no variance along its component.
NOTHING = 2.0**-50

_PARTIAL = "part int, row int, n long, digits array<long>"


# ---------------------------------------------------------------- exact integers


def integers(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Which rows of a list column are usable, and by length: their row numbers and the integers of their entries."""
    n = len(column)
    lengths = np.asarray(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten()
    flat = np.floor(np.asarray(values.cast(pa.float64()).fill_null(np.nan), np.float64) * SCALE)
    bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) <= LARGEST))])
    ends = np.cumsum(lengths)
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    by_length = {}
    for d in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == d))
        at = (ends[rows] - d)[:, None] + np.arange(d)
        by_length[int(d)] = rows, flat[at].astype(np.int64) + OFFSET
    return good if n else np.zeros(0, bool), by_length


def limbs(y: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` float64 arrays of LIMB bits each, lowest first; the highest has the sign."""
    low = [(y >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(count - 1)]
    return [x.astype(np.float64) for x in (*low, y >> (LIMB * (count - 1)))]


def limb_count(largest: int) -> int:
    """Limbs that hold integers of up to ``largest`` in size, the highest one with its sign."""
    return -(-largest.bit_length() // LIMB) or 1


class Gram:
    """Sums of y and of y times its transpose over rows of integers, exact."""

    def __init__(self, d: int, largest: int):
        self.d, self.count, self.n = d, limb_count(largest), 0
        self.total = np.zeros(d, object)
        self.products = np.zeros((d, d), object)
        self._held = 0
        self._open()

    def _open(self) -> None:
        pairs = [(a, b) for a in range(self.count) for b in range(a, self.count)]
        self._sums = {p: np.zeros((self.d, self.d)) for p in pairs}
        self._ones = [np.zeros(self.d) for _ in range(self.count)]
        self._held = 0

    def add(self, y: np.ndarray, rows: int = 1 << 15) -> None:
        for k in range(0, len(y), rows):
            block = limbs(y[k : k + rows], self.count)
            if self._held + len(block[0]) > 1 << (53 - 2 * LIMB):
                self._close()
            for (a, b), s in self._sums.items():
                s += block[a].T @ block[b]
            for s, x in zip(self._ones, block, strict=True):
                s += x.sum(axis=0)
            self._held += len(block[0])
        self.n += len(y)

    def _close(self) -> None:
        """What floats hold moves to the big integers."""
        whole = lambda x: x.astype(np.int64).astype(object)
        for (a, b), s in self._sums.items():
            x = whole(s)
            self.products += (x if a == b else x + x.T) * (1 << (LIMB * (a + b)))
        for k, s in enumerate(self._ones):
            self.total += whole(s) * (1 << (LIMB * k))
        self._open()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._close()
        return self.total, self.products


def to_digits(x: np.ndarray, count: int) -> np.ndarray:
    """Big integers as ``count`` digits of DIGIT bits, lowest first; the highest has the sign."""
    out, mask = np.empty((len(x), count), np.int64), (1 << DIGIT) - 1
    for k in range(count):
        out[:, k] = x & mask if k < count - 1 else x
        x = x >> DIGIT
    return out


def from_digits(digits: np.ndarray) -> np.ndarray:
    total = np.zeros(len(digits), object)
    for k in reversed(range(digits.shape[1])):
        total = total * (1 << DIGIT) + digits[:, k].astype(object)
    return total


# ---------------------------------------------------------------- the fit


@dataclass(frozen=True)
class Fit:
    """n vectors of d dimensions; the mean is shift + rest / n, rest between -n and n."""

    n: int
    shift: np.ndarray  # long
    rest: np.ndarray  # Python integers
    largest: int  # no integer is further from its shift
    products: np.ndarray  # n * n * covariance, Python integers
    components: np.ndarray  # d x k
    variances: np.ndarray  # k, zero where rounding hides the variance
    explained: list[float | None]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.shift).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN along components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            z = self.centred(x) @ self.components / np.sqrt(self.variances)
        z[:, self.variances == 0] = np.nan
        return z

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S) squared, as Python integers."""
        y, rest = x - self.shift, np.abs(self.rest).max(initial=0)
        kind = np.int64 if len(self.shift) * self.largest * max(self.largest, rest) < 1 << 62 else object
        y, r = y.astype(kind), self.rest.astype(kind)
        squares, cross = (y * y).sum(axis=1).astype(object), (y * r).sum(axis=1).astype(object)
        return self.n * self.n * squares - 2 * self.n * cross + int((self.rest * self.rest).sum())


def _batches(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        _, by_length = integers(b.column("embedding"))
        if d in by_length:
            yield b, *by_length[d]


def ranges(vectors: DataFrame) -> DataFrame:
    """Of each length and dimension: n, the sum and the range of the integers. Summed in each batch, then by Spark."""
    ddl = "d int, pos int, n long, high long, low long, least long, most long"
    kinds = arrow_schema(vectors.sparkSession, ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, (_, x) in integers(b.column("embedding"))[1].items():
                high = x >> 31
                columns = [
                    np.full(d, d, np.int32), np.arange(d, dtype=np.int32), np.full(d, len(x)), high.sum(axis=0),
                    (x - (high << 31)).sum(axis=0), x.min(axis=0), x.max(axis=0),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    whole = F.col("high").cast("decimal(20,0)") * F.lit(1 << 31) + F.col("low")
    return (
        vectors.select("embedding")
        .mapInArrow(rows, ddl)
        .groupBy("d", "pos")
        .agg(F.sum("n").alias("n"), F.sum(whole.cast("decimal(28,0)")).alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
    )


def _products(vectors: DataFrame, n: int, shift: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y and of y times its transpose over all vectors, y = x - shift: one row of the matrix a record, added in a tree."""
    d = len(shift)
    count = -(-(n * largest * largest).bit_length() // DIGIT) + 1
    kinds = arrow_schema(vectors.sparkSession, _PARTIAL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gram = Gram(d, largest)
        for _, _, x in _batches(batches, d):
            gram.add(x - shift)
        if gram.n:
            total, products = gram.result()
            part = TaskContext.get().partitionId()
            for k, values in enumerate([*products, total]):
                digits = to_digits(values, count).ravel()
                yield pa.RecordBatch.from_pylist([{"part": part, "row": k, "n": gram.n, "digits": digits}], schema=kinds)

    def merge(table: pa.Table) -> pa.Table:
        lists = table.column("digits").combine_chunks()
        total = np.asarray(lists.flatten(), np.int64).reshape(table.num_rows, -1).sum(axis=0)
        n = sum(table.column("n").to_pylist())
        return pa.Table.from_pylist([{"part": table.column("part")[0].as_py(), "row": table.column("row")[0].as_py(), "n": n, "digits": total}], schema=kinds)

    merged = vectors.select("embedding").mapInArrow(rows, _PARTIAL)
    for _ in range(2):  # at most FAN partial rows meet in a task, and a FAN * FAN-th of them on the driver
        merged = merged.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part", "row").applyInArrow(merge, _PARTIAL)
    sums = np.zeros((d + 1, d), object)
    for r in merged.toLocalIterator():
        sums[r["row"]] += from_digits(np.array(r["digits"], np.int64).reshape(d, count))
    return sums[d], sums[:d]


def fit(vectors: DataFrame, components: int = 8) -> Fit | None:
    """Exact covariance of all usable vectors of the commonest length (ties: the longest), and its leading components; None without any."""
    seen = stored(ranges(vectors), "ranges")
    longest = seen.where("pos = 0").orderBy(F.desc("n"), F.desc("d")).select("d").head()
    if longest is None:
        return None
    each = seen.where(F.col("d") == longest["d"]).orderBy("pos").collect()  # one row a dimension
    n, totals = each[0]["n"], [int(r["total"]) for r in each]
    shift = [(2 * s + n) // (2 * n) for s in totals]  # the nearest integers to the means
    largest = max(max(r["most"] - m, m - r["least"]) for r, m in zip(each, shift, strict=True))
    shift = np.array(shift, np.int64)
    rest, products = _products(vectors, n, shift, largest)
    covariance = n * products - rest[:, None] * rest[None, :]
    return _decomposed(n, shift, rest, largest, covariance, components)


def _decomposed(n: int, shift: np.ndarray, rest: np.ndarray, largest: int, products: np.ndarray, components: int) -> Fit:
    d, square = len(shift), n * n
    # Whole numbers divided by a whole number: each entry is rounded once.
    v = np.array([[x / square for x in row] for row in products], np.float64).reshape(d, d)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    values = np.where(values > NOTHING * d * max(values.max(initial=0), 0), values, 0.0)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])  # the largest entry is positive
    trace = int(np.trace(products)) / square
    explained = [float(e) / trace if trace else None for e in values]
    return Fit(n, shift, rest, largest, products, vectors * sign, values, explained)


def identity_error(vectors: DataFrame, fitted: Fit) -> float | None:
    """Largest entry of the whitened vectors' covariance less the identity, over components with variance; None without any.

    Each task centres its own vectors before it multiplies them; means and products of the tasks are put together.
    """
    d, live = len(fitted.shift), np.flatnonzero(fitted.variances)
    k = len(live)
    if not k:
        return None
    ddl = "part int, n long, mean array<double>, products array<double>"
    kinds = arrow_schema(vectors.sparkSession, ddl)

    def together(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for m, other, more in parts:
            gap = other - mean
            products = products + more + np.outer(gap, gap) * (n * m / (n + m))
            mean, n = mean + gap * (m / (n + m)), n + m
        return n, mean, products

    def record(part: int, n: int, mean: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"part": part, "n": n, "mean": mean, "products": products.ravel()}], schema=kinds)

    def of(r) -> tuple[int, np.ndarray, np.ndarray]:
        return r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def each():
            for _, _, x in _batches(batches, d):
                z = fitted.whitened(x)[:, live]
                mean = z.mean(axis=0)
                yield len(z), mean, (z - mean).T @ (z - mean)

        n, mean, products = together(each())
        if n:
            yield record(TaskContext.get().partitionId(), n, mean, products)

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record(table.column("part")[0].as_py(), *together(map(of, table.to_pylist())))])

    merged = vectors.select("embedding").mapInArrow(rows, ddl)
    for _ in range(2):
        merged = merged.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part").applyInArrow(merge, ddl)
    n, _, products = together(map(of, merged.orderBy("part").toLocalIterator()))
    return float(np.abs(products / n - np.eye(k)).max())


# ---------------------------------------------------------------- the operator


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """Whitened coordinates of each usable row of ``vectors`` (vec_id, embedding), one row a component.

    Gives vec_id, component (from 1, by falling variance), n (rows of the fit), deviation
    (exact squared distance from the mean, times n squared; null where it does not fit a
    long), whitened, explained (share of the variance), identity_error (one value) and
    deviation_digits (the deviation in decimal, whatever its size).

    Null vectors, vectors with null or non-finite entries (or ones beyond 2**61 / SCALE),
    empty vectors, and vectors of another length than the commonest one are left out.
    Repeated rows count each time and stay; null ids stay. Where there is no variance along a
    component (fewer different vectors than components) whitened is null, and explained
    too if there is none at all. No usable vectors give no rows. Other columns are not
    looked at.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    ddl = f"vec_id {kind}, deviation long, deviation_digits string, whitened array<double>"
    vectors = vectors.select("vec_id", "embedding")
    small_batches(vectors.sparkSession)
    fitted = fit(vectors, components)
    if fitted is None:
        explained, error, n = [], None, 0
    else:
        explained, error, n = fitted.explained, identity_error(vectors, fitted), fitted.n
    kinds = arrow_schema(vectors.sparkSession, ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, at, x in _batches(batches, len(fitted.shift)) if fitted else ():
            deviations = fitted.deviations(x)
            z = fitted.whitened(x)
            offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
            columns = [
                b.column("vec_id").take(pa.array(at)),
                pa.array([v if v < 1 << 63 else None for v in deviations], pa.int64()),
                pa.array([str(v) for v in deviations]),
                pa.ListArray.from_arrays(offsets, pa.array(z.ravel(), from_pandas=True)),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    found = vectors.mapInArrow(rows, ddl)
    pos = fresh(found, "pos")
    share = F.array(*[F.lit(e).cast("double") for e in explained]) if explained else F.array().cast("array<double>")
    return found.select("vec_id", "deviation", "deviation_digits", F.posexplode("whitened").alias(pos, "whitened")).select(
        "vec_id",
        (F.col(pos) + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col(pos)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_digits",
    )
