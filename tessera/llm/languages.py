"""Language identification by sparse multinomial logistic regression.

A text becomes the TF-IDF weights of its character n-grams, hashed into a fixed number of
features. The model is trained by follow-the-regularised-leader with elastic-net
penalties, so most weights are exactly zero: shards of the sample make their passes side by side,
each from the same state, and the states, which are sums of gradients, are averaged after
every pass. Labelled texts that took no part then set one temperature, by which the scores become
probabilities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, arrow_schema, small_batches, stored
from tessera.llm.quality_classifier import remainder

#: Bound of the sample that trains and calibrates: different texts of each language.
SAMPLE_DOCS = 1500
#: Languages that are learnt, at most: those of most texts.
LANGUAGES = 128
#: Hashed features, and the lengths of the n-grams.
BITS, GRAMS = 16, (1, 2, 3)
#: Shards of the sample, passes over it, and the remainder of a text's hash, of CALIBRATION, that calibrates.
SHARDS, PASSES, CALIBRATION = 8, 4, 5
#: Learning rate, its smoothing, and the penalties on sizes and squares of weights.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.02
#: Temperatures that are tried.
TEMPERATURES = np.geomspace(0.01, 20.0, 153)
#: Partial sums that meet in a task.
FAN = 64

UNKNOWN = "und"


# ---------------------------------------------------------------- features


class Grams:
    """Hashed character n-grams of a text's letters, in lower case, one blank in place of whatever is between."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self._letters = np.zeros(0x110000, bool)
        self._known = np.zeros(0x110000 >> 8, bool)

    def codes(self, text: str) -> np.ndarray:
        """Code points with a blank before, after and between stretches of letters; none without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        for block in np.flatnonzero(np.bincount(points >> 8, minlength=1).astype(bool)):
            if not self._known[block]:
                self._letters[block << 8 : (block + 1) << 8] = [chr(c).isalpha() for c in range(block << 8, (block + 1) << 8)]
                self._known[block] = True
        letter = self._letters[points]
        if not letter.any():
            return np.zeros(0, np.uint32)
        points = np.concatenate([[32], np.where(letter, points, 32), [32]]).astype(np.uint32)
        blank = points == 32
        return points[~(blank & np.concatenate([[False], blank[:-1]]))]

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(features, how often), features ascending; none for a text without letters."""
        c = self.codes(text) if text else np.zeros(0, np.uint32)
        if not len(c):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        every, h = [], np.zeros(len(c), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] * np.uint32(0x01000193)) ^ (c[n - 1 :] + np.uint32(n))
            if n in GRAMS:
                every.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits))
        at = np.bincount(np.concatenate(every), minlength=1 << self.bits)
        features = np.flatnonzero(at)
        return features, at[features]


def weights(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(1 + log tf) * idf, of length 1."""
    x = (1 + np.log(counts)) * idf[features]
    size = np.sqrt(x @ x)
    return x / size if size else x


def inverse_frequencies(n: int, texts_with: np.ndarray) -> np.ndarray:
    return np.log((1 + n) / (1 + texts_with)) + 1


# ---------------------------------------------------------------- the model


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Leader:
    """Follow the regularised leader: z and the sums of squared gradients, for each feature (the last is the bias) and language."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls, features: int, languages: int) -> Leader:
        return cls(np.zeros((features + 1, languages)), np.zeros((features + 1, languages)))

    def rows(self, at: np.ndarray | slice) -> np.ndarray:
        """The weights of some features; zero where z is within the penalty on sizes. The bias has no penalty."""
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0
        return w

    def learn(self, features: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(features, len(self.z) - 1), np.append(x, 1.0)
        w = self.rows(at)
        slope = softmax(x @ w)
        slope[label] -= 1
        g = np.outer(x, slope)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features + 1, languages
    temperature: float = 1.0

    def logits(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weights(features, counts, self.idf) @ self.weights[features] + self.weights[-1]

    def predict(self, features: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(features) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(features, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


# ---------------------------------------------------------------- fitting


def learnable(docs: DataFrame) -> DataFrame:
    """(text, lang) of the rows that may be learnt from."""
    return docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder("doc_id", 5) != 0)).select("text", F.col("lang").cast("string").alias("lang"))


def document_frequencies(texts: DataFrame, bits: int = BITS) -> tuple[int, np.ndarray]:
    """Texts with letters and, of them, those with each feature, over all rows; one array a task, added in a tree."""
    ddl = "part int, n long, texts_with array<long>"
    kinds = arrow_schema(texts.sparkSession, ddl)
    small_batches(texts.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        grams, n, total = Grams(bits), 0, np.zeros(1 << bits, np.int64)
        for b in batches:
            for text in b.column("text"):
                features, _ = grams.counts(text.as_py())
                total[features] += 1
                n += len(features) > 0
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "n": n, "texts_with": total}], schema=kinds)

    def merge(table: pa.Table) -> pa.Table:
        total = sum(np.asarray(x.values, np.int64) for x in table.column("texts_with"))
        n = sum(table.column("n").to_pylist())
        return pa.Table.from_pylist([{"part": table.column("part")[0].as_py(), "n": n, "texts_with": total}], schema=kinds)

    merged = texts.select("text").mapInArrow(rows, ddl)
    for _ in range(2):
        merged = merged.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("part").applyInArrow(merge, ddl)
    n, total = 0, np.zeros(1 << bits, np.int64)
    for r in merged.toLocalIterator():
        n, total = n + r["n"], total + np.array(r["texts_with"])
    return n, total


def sample(texts: DataFrame, most: int = SAMPLE_DOCS, languages: int = LANGUAGES) -> tuple[DataFrame, list[str]]:
    """(text, lang, hash) of at most ``most`` different texts of each language, those of least hash, and the languages.

    About three times as many are taken by their hash as they are read, so that neither a
    language with most of the rows nor a text with many copies meets in one task.
    """
    hashed = texts.withColumn("hash", F.xxhash64("text"))
    several = hashed.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n")).orderBy(F.desc("n"), "lang")
    least = {r["lang"]: min(1.0, (3 * most + 50) / max(r["n"], 1)) for r in several.limit(languages).collect()}
    if not least:
        return hashed.where(F.lit(False)), []
    order, span = F.pmod("hash", F.lit(1 << 40)), float(1 << 40)
    share = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col("lang"))
    once = hashed.where(order < share * span).groupBy("lang", "text", "hash").agg(F.count("*").alias("copies"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "text"))
    return once.withColumn("rank", rank).where(F.col("rank") <= most).select("text", "lang", "hash"), sorted(least)


def featured(texts: DataFrame, languages: list[str], bits: int = BITS) -> DataFrame:
    """The sample as numbers: label, shard (null: for calibration), hash, features and counts."""
    numbers = {x: k for k, x in enumerate(languages)}

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        grams = Grams(bits)
        for b in batches:
            each = [grams.counts(t) for t in b["text"]]
            yield {
                "label": [numbers[x] for x in b["lang"]],
                "hash": b["hash"],
                "features": [f for f, _ in each],
                "counts": [c for _, c in each],
            }

    found = arrow_map(texts.select("text", "lang", "hash"), rows, "label int, hash long, features array<int>, counts array<int>")
    dealt = F.xxhash64("hash")
    shard = F.when(F.pmod(dealt, F.lit(CALIBRATION)) != 0, F.pmod(F.shiftright(dealt, 20), F.lit(max(SHARDS, len(languages)))))
    return found.where(F.size("features") > 0).withColumn("shard", shard.cast("int"))


def _texts(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(label, features, counts) of each text, in the order of their hashes."""
    columns = {c: table.column(c).combine_chunks() for c in ("label", "hash", "features", "counts")}
    lists = {c: (np.asarray(columns[c].offsets), np.asarray(columns[c].values)) for c in ("features", "counts")}
    labels = columns["label"].to_pylist()
    for k in np.argsort(np.asarray(columns["hash"]), kind="stable"):
        yield labels[k], *(values[at[k] : at[k + 1]] for at, values in lists.values())


def _pass(sent: Broadcast, kinds: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """One pass over a shard's texts, from the state that is sent."""

    def learn(table: pa.Table) -> pa.Table:
        start, idf = sent.value
        mine = Leader(start.z.copy(), start.n.copy())
        for label, features, counts in _texts(table):
            mine.learn(features, weights(features, counts, idf), label)
        return pa.Table.from_pylist([{"z": mine.z.tobytes(), "n": mine.n.tobytes()}], schema=kinds)

    return learn


def train(sampled: DataFrame, languages: list[str], idf: np.ndarray, passes: int = PASSES) -> Model:
    """FTRL over the shards of ``featured``; what the driver holds is features times languages in size."""
    spark, ddl = sampled.sparkSession, "z binary, n binary"
    kinds = arrow_schema(spark, ddl)
    leader = Leader.new(len(idf), len(languages))
    for _ in range(passes):
        sent = spark.sparkContext.broadcast((leader, idf))  # features * languages of bounded number
        dealt = sampled.where(F.col("shard").isNotNull()).repartition(max(SHARDS, len(languages)), "shard")
        states = stored(dealt.groupBy("shard").applyInArrow(_pass(sent, kinds), ddl), "states").toLocalIterator()  # one at a time
        z, n, shards = np.zeros_like(leader.z), np.zeros_like(leader.n), 0
        for r in states:
            z += np.frombuffer(r["z"]).reshape(z.shape)
            n += np.frombuffer(r["n"]).reshape(n.shape)
            shards += 1
        sent.unpersist()
        if not shards:
            break
        leader = Leader(z / shards, n / shards)
    return Model(languages, idf, leader.rows(slice(None)))


def losses(model: Model, texts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of texts, and at each temperature the sums of -log p of their own language and of all languages."""
    n, own, every = 0, np.zeros(len(TEMPERATURES)), np.zeros(len(TEMPERATURES))
    for label, features, counts in texts:
        scaled = model.logits(features, counts) / TEMPERATURES[:, None]
        top = scaled.max(axis=1)
        each = (top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)))[:, None] - scaled
        n, own, every = n + 1, own + each[:, label], every + each.sum(axis=1)
    return n, own, every


def temperature(n: int, own: np.ndarray, every: np.ndarray, languages: int) -> float:
    """The likeliest temperature, 1 without texts.

    A text counts as (n + 1) / (n + languages) of its own language and 1 / (n + languages) of each other: where
    all n are told apart rightly, scores do not claim more than n texts can show.
    """
    share = 1 / (n + languages)
    return float(TEMPERATURES[((n + 1) * share * own + share * (every - own)).argmin()]) if n else 1.0


def calibrated(model: Model, sampled: DataFrame) -> Model:
    """``model`` with the temperature that suits the texts that did not train it."""
    ddl = "n long, own array<double>, every array<double>"
    kinds = arrow_schema(sampled.sparkSession, ddl)
    sent = sampled.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, own, every = losses(sent.value, _texts(pa.Table.from_batches([b])))
            yield pa.RecordBatch.from_pylist([{"n": n, "own": own, "every": every}], schema=kinds)

    n, own, every = 0, np.zeros(len(TEMPERATURES)), np.zeros(len(TEMPERATURES))
    for r in sampled.where(F.col("shard").isNull()).mapInArrow(rows, ddl).toLocalIterator():  # a row a batch of the sample
        n, own, every = n + r["n"], own + np.array(r["own"]), every + np.array(r["every"])
    return Model(model.languages, model.idf, model.weights, temperature(n, own, every, len(model.languages)))


def learn(docs: DataFrame, most: int = SAMPLE_DOCS, bits: int = BITS) -> Model:
    """The model of a sample of the rows that may be learnt from; document frequencies are those of all of these rows."""
    texts = learnable(docs)
    picked, languages = sample(texts, most)
    if not languages:
        return Model([], np.zeros(1 << bits), np.zeros((1 + (1 << bits), 0)))
    idf = inverse_frequencies(*document_frequencies(texts, bits))
    sampled = stored(featured(picked, languages, bits), "languages")
    return calibrated(train(sampled, languages, idf), sampled)


# ---------------------------------------------------------------- the operator


def identify(docs: DataFrame, most: int = SAMPLE_DOCS, bits: int = BITS) -> DataFrame:
    """Language of each row of ``docs`` (doc_id, text, lang), learnt from its labelled rows.

    Gives doc_id, held_out (crc32 of the id modulo 5 is 0: never learnt from), lang_pred and
    score, the calibrated probability of lang_pred. A null text, or one without a letter,
    is ``und`` with score 0, and so is every text if there is nothing to learn from. Only
    the text enters a prediction. Rows without a language teach nothing; of copies of
    a text one teaches. Repeated rows and null ids stay; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, most, bits))  # features * languages, both bounded

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        model, grams = sent.value, Grams(bits)
        for b in batches:
            each = [model.predict(*grams.counts(t)) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "lang_pred": [x for x, _ in each], "score": [p for _, p in each]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = arrow_map(docs.select("doc_id", "text"), rows, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
