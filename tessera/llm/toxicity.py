"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with a probability that is the
logistic of its features' weights; a document is toxic if any sentence is (noisy-or),
so document labels alone train the sentences, and the sentences that carry a document's
score are the ones that offend.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, stored
from tessera.llm.quality_classifier import remainder

#: Bound of the training sample: documents of either label.
SAMPLE_DOCS = 4000
#: Features of the model at most, and what the evidence of each (log likelihood ratio of its toxic documents) must reach.
FEATURES, LEAST_EVIDENCE = 20_000, 18.0
PREFIXES = (6,)

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches between sentence marks and line ends, those without a letter left out."""
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(text, *m.span())]


def features(sentence: str) -> set[str]:
    """The sentence's words, lower-cased, and the beginnings of longer ones."""
    words = set(_WORD.findall(sentence.lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


@dataclass
class NoisyOr:
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.nothing = float(np.logaddexp(0, self.bias))

    def strength(self, sentence: str) -> float:
        """-log(1 - p) of the sentence."""
        get = self.weights.get
        z = sum(w for f in features(sentence) if (w := get(f)) is not None)
        return float(np.logaddexp(0, self.bias + z)) if z else self.nothing

    def document(self, text: str | None, worst: bool = False) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and, if ``worst`` are asked for, its sentences of at least even odds."""
        if not text:
            return 0.0, []
        total, found = 0.0, []
        for a, b in sentences(text):
            s = self.strength(text[a:b])
            total += s
            if worst and s >= np.log(2):
                found.append((a, b, float(-np.expm1(-s))))
        return float(-np.expm1(-total)), found


@dataclass
class Bags:
    """The sampled documents as numbers: which document a sentence is of, and which features it has."""

    toxic: np.ndarray  # of each document
    doc: np.ndarray  # of each sentence
    sentence: np.ndarray  # of each occurrence of a feature
    feature: np.ndarray


def evidence(n_toxic: Column, n_other: Column, toxic: int, other: int) -> Column:
    """Log likelihood ratio of a feature's toxic documents, smoothed."""
    rate = lambda n, of: (n + 0.5) / (of + 1)
    return n_toxic * F.log(rate(n_toxic, toxic) / rate(n_other, other))


def train(
    bags: Bags, names: list[str], weight: tuple[float, float] = (1.0, 1.0), rounds: int = 300, ridge: float = 1e-5
) -> NoisyOr:
    """Gradient ascent (Adam) on the noisy-or likelihood of document labels.

    ``weight`` of a document by its label makes up for a sample that takes more of one
    label. Without both labels every sentence gets the share of toxic documents, spread
    over the sentences of a document.
    """
    y, n_docs, n_sentences = bags.toxic.astype(bool), len(bags.toxic), len(bags.doc)
    c = np.where(y, weight[1], weight[0])
    share = float(np.clip(c[y].sum() / max(c.sum(), 1e-9), 1e-4, 0.5))
    start = float(np.log(share / max(n_sentences / max(n_docs, 1), 1.0)))
    if not y.any() or y.all():
        return NoisyOr({}, start)
    k = len(names)
    theta, bias = np.zeros(k), start - 2.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, rounds + 1):
        z = bias + np.bincount(bags.sentence, theta[bags.feature], minlength=n_sentences)
        strength = np.logaddexp(0, z)
        p = -np.expm1(-strength)
        total = np.bincount(bags.doc, strength, minlength=n_docs)
        slope = c * np.where(y, 1 / np.expm1(np.maximum(total, 1e-6)), -1.0)
        g = slope[bags.doc] * p
        grad = np.append(np.bincount(bags.feature, g[bags.sentence], minlength=k) - ridge * n_docs * theta, g.sum()) / n_docs
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        step = 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta, bias = theta + step[:-1], min(bias + step[-1], -2.0)
    return NoisyOr({f: float(w) for f, w in zip(names, theta, strict=True) if abs(w) > 1e-3}, float(bias))


def sample(docs: DataFrame, labels: DataFrame, docs_each: int = SAMPLE_DOCS) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the first ``docs_each`` documents of either label in the order of a hash of their ids, and how many there are of each."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0))
        .distinct()
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs_each) for y in (0, 1)]
    both = chosen[0].unionByName(chosen[1])
    return docs.select("doc_id", "text").join(F.broadcast(both), "doc_id").select("text", "toxic"), counts  # 2 * docs_each ids


def learn(docs: DataFrame, labels: DataFrame, docs_each: int = SAMPLE_DOCS, least_evidence: float = LEAST_EVIDENCE) -> NoisyOr:
    """The model of a sample. Texts stay on the executors; the driver gets the features that tell and where they are.

    Features that are no commoner in toxic documents than in others, or too rare to tell,
    are left out: they could excuse a label, or take one by heart, but not explain it.
    """
    taken, counts = sample(docs, labels, docs_each)
    taken = stored(taken, "toxicity-sample")
    n = {y: taken.where(F.col("toxic") == y).count() for y in (0, 1)}

    def features_of(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            each = [set().union(*(features(t[i:j]) for i, j in sentences(t))) if t else set() for t in b["text"]]
            yield {"toxic": b["toxic"], "features": [sorted(x) for x in each]}

    per_doc = arrow_map(taken, features_of, "toxic int, features array<string>").select("toxic", F.explode("features").alias("feature"))
    seen = per_doc.groupBy("feature").agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0"))
    told = seen.withColumn("evidence", evidence(F.col("n1"), F.col("n0"), n[1], n[0])).where(F.col("evidence") >= least_evidence)
    names = [r["feature"] for r in told.orderBy(F.desc("evidence"), "feature").limit(FEATURES).collect()]
    number = docs.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(names)})  # FEATURES at most

    def places(batches: Iterator[dict]) -> Iterator[dict]:
        get = number.value.get
        for b in batches:
            out: dict[str, list] = {"toxic": b["toxic"], "n": [], "sentence": [], "feature": []}
            for t in b["text"]:
                spans = sentences(t) if t else []
                found = [(k, x) for k, (i, j) in enumerate(spans) for f in features(t[i:j]) if (x := get(f)) is not None]
                out["n"].append(len(spans))
                out["sentence"].append([k for k, _ in found])
                out["feature"].append([x for _, x in found])
            yield out

    rows = arrow_map(taken, places, "toxic int, n int, sentence array<int>, feature array<int>").toLocalIterator()
    toxic, sizes, sentence, feature, at = [], [], [], [], 0
    for r in rows:
        toxic.append(r["toxic"])
        sizes.append(r["n"])
        sentence.append(np.array(r["sentence"], np.int64) + at)
        feature.append(np.array(r["feature"], np.int64))
        at += r["n"]
    flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    bags = Bags(np.array(toxic, np.int64), np.repeat(np.arange(len(sizes)), sizes), flat(sentence), flat(feature))
    return train(bags, names, tuple(counts.get(y, 0) / max(n[y], 1) for y in (0, 1)))


def detect(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, docs_each: int = SAMPLE_DOCS) -> DataFrame:
    """Toxicity of each row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, toxic).

    Gives doc_id, held_out, score (0 to 1), predicted (1 if the score reaches
    ``threshold``) and offending: start, end (code points) and score of the sentences that
    are more likely toxic than not. Labels of rows whose crc32(doc_id) modulo 5 is 0 are
    never looked at. Only the text enters a score; null and empty texts have no
    sentences and score 0. Null labels and null ids teach nothing. Repeated rows stay. Other columns
    are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, docs_each))  # FEATURES weights at most

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        model = sent.value
        for b in batches:
            each = [model.document(t, worst=True) for t in b["text"]]
            yield {
                "doc_id": b["doc_id"],
                "score": [s for s, _ in each],
                "offending": [[{"start": a, "end": z, "score": p} for a, z, p in found] for _, found in each],
            }

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, score double, offending array<struct<start:int,end:int,score:double>>"
    return arrow_map(docs.select("doc_id", "text"), rows, ddl).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "offending",
    )
