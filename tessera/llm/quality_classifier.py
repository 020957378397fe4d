"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has its mean and covariance of transformed counts, the covariance drawn
towards the pooled one and towards its own diagonal. A score is the logistic of the
difference of the classes' log densities, where the Mahalanobis distances come from
Cholesky factors that are computed once. The fit needs only sums and sums of products
over the labelled rows, so it sees all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import row_key, settled, stored, without
from tessera.llm.quality_rules import text_counts


def statistics() -> dict[str, Column]:
    """The transformed statistics of ``text_counts``' columns; shares are smoothed, so an empty text has values too."""

    def share(part: Column, of: Column) -> Column:
        return F.log((part + 0.5) / (of + 10.0))

    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "log_words": F.log1p(n),
        "word_length": F.log((chars + 5.0) / (n + 1.0)),
        "symbols": share(F.col("n_symbols"), n),
        "repeated_lines": share(F.col("n_dup_lines"), F.col("n_lines")),
        "repeated_words": share(F.col("n_repeat_words"), n),
        "capitals": share(F.col("n_upper"), F.col("n_letters")),
        "marks": share(F.col("n_marks"), n),
        "other_characters": share(chars - F.col("n_letters"), chars),
    }


@dataclass
class Class:
    prior: float
    mean: np.ndarray
    whiten: np.ndarray  # inverse of the covariance's Cholesky factor
    log_scale: float  # log of the factor's determinant

    @classmethod
    def of(cls, prior: float, mean: np.ndarray, covariance: np.ndarray) -> Class:
        factor = np.linalg.cholesky(covariance)
        return cls(prior, mean, np.linalg.inv(factor), float(np.log(np.diag(factor)).sum()))

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return np.log(self.prior) - self.log_scale - 0.5 * (z * z).sum(axis=1)

    def density_column(self, names: list[str]) -> Column:
        """The same as an expression over the columns ``names``."""
        centred = [F.col(n) - float(m) for n, m in zip(names, self.mean, strict=True)]
        distance = F.lit(0.0)
        for row in self.whiten:
            z = F.lit(0.0)
            for w, x in zip(row.tolist(), centred, strict=True):
                if w:
                    z = z + x * w
            distance = distance + z * z
        return float(np.log(self.prior) - self.log_scale) - distance * 0.5


@dataclass
class Discriminant:
    bad: Class
    good: Class

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        odds = np.clip(self.good.log_density(x) - self.bad.log_density(x), -500, 500)
        return 1 / (1 + np.exp(-odds))

    def score_column(self, names: list[str]) -> Column:
        return 1 / (1 + F.exp(self.bad.density_column(names) - self.good.density_column(names)))


def fit(sums: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float = 0.1, diagonal: float = 0.1, floor: float = 0.02) -> Discriminant:
    """From each label's count, sum and sum of outer products.

    ``pooled`` and ``diagonal`` are the weights of the pooled covariance and of the
    class's own diagonal; ``floor`` is added to every variance. Two rows of each label,
    at the mean of all, are added to the priors, so that a label without rows has one;
    its mean and covariance are those of all rows, or standard ones if there are none.
    """
    d = max((len(s) for _, s, _ in sums.values()), default=len(statistics()))
    empty = (0, np.zeros(d), np.zeros((d, d)))
    parts = {y: sums.get(y, empty) for y in (0, 1)}
    total = sum(n for n, _, _ in parts.values())
    mean_all = sum(s for _, s, _ in parts.values()) / max(total, 1)
    scatter, means = {}, {}
    for y, (n, s, ss) in parts.items():
        means[y] = s / n if n else mean_all
        scatter[y] = ss - n * np.outer(means[y], means[y])
    within = (scatter[0] + scatter[1]) / max(total - 2, 1) + floor * np.eye(d) if total else np.eye(d)
    classes = []
    for y, (n, _, _) in parts.items():
        own = scatter[y] / (n - 1) if n > d else within
        own = (1 - pooled) * own + pooled * within
        own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + floor * np.eye(d)
        classes.append(Class.of((n + 2) / (total + 4), means[y], own))
    return Discriminant(*classes)


def sums_by_label(x: DataFrame, label: str, names: list[str]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of ``names`` for each value of ``label``; one row a label reaches the driver."""
    d = len(names)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    aggregates = [F.count("*").alias("n")] + [F.sum(c).alias(f"s{i}") for i, c in enumerate(names)]
    aggregates += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]
    out = {}
    for r in x.groupBy(label).agg(*aggregates).collect():
        outer = np.zeros((d, d))
        for i, j in pairs:
            outer[i, j] = outer[j, i] = r[f"p{i}_{j}"]
        out[int(r[label])] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), outer)
    return out


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id reads as an empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **regularisation: float) -> DataFrame:
    """Quality of each row of ``docs`` (doc_id, text), learnt from ``labels`` (doc_id, quality).

    Gives doc_id, held_out, score (0 to 1) and predicted (1 if the score reaches
    ``threshold``). Labels of rows whose crc32(doc_id) modulo 3 is 1 are never looked at.
    Only the text enters a score: a null one counts as empty, and an empty one has a
    score like any other. Null labels and null ids teach nothing; a label said twice
    counts once, one said both ways counts both ways. Repeated rows stay. Other columns
    are not looked at.
    """
    names = list(statistics())
    x = stored(_statistics(docs, "doc_id"), "statistics")
    model = learn(x, labels, **regularisation)
    return x.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        model.score_column(names).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _statistics(docs: DataFrame, *keep: str) -> DataFrame:
    return text_counts(docs, *keep).select(*keep, *(c.alias(n) for n, c in statistics().items()))


def learn(x: DataFrame, labels: DataFrame, **regularisation: float) -> Discriminant:
    """From the statistics ``x`` of documents and those of their ``labels`` that are not held out."""
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & (remainder("doc_id", 3) != 1))
        .distinct()
    )
    return fit(sums_by_label(x.join(known, "doc_id"), "quality", list(statistics())), **regularisation)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **regularisation: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores at least ``threshold`` (see ``classify``)."""
    key, names = row_key(docs), list(statistics())

    def rejected() -> DataFrame:
        # Stored: a filter on statistics that are still expressions would be pushed into them, and work each out anew for every use.
        x = stored(_statistics(docs.select(key.alias("row"), "text"), "row"), "statistics")
        model = learn(x.select(F.col("row.id").alias("doc_id"), *names), labels, **regularisation)
        return x.where(model.score_column(names) < threshold).select("row").distinct()

    return without(docs, key, settled(docs.sparkSession, rejected, "rejected"))
