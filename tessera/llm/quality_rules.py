"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Everything that touches documents is a DataFrame expression. A rule's vote is 1 (good),
-1 (bad) or 0 (abstains). Documents with the same votes are alike to the model, so
expectation-maximisation runs over the counts of vote patterns, of which there are at
most three to the number of rules, whatever the corpus; these counts cover all
documents, and the fitted weights go back into one more expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Low bits of a packed window hash that hold its place in the text; an array has fewer than 2 ** 31 elements.
PLACE_BITS = 31


def text_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with ``text`` to the columns ``keep`` and the counts that rules look at.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_lines (lines
    with a word), n_upper (A-Z), n_letters (letters and digits of any script), n_marks (`[!|{}]`). A null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text_", "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    base = docs.select(*keep, text.alias("text_")).select(
        *keep,
        F.regexp_extract_all("text_", F.lit(WORD), F.lit(0)).alias("w"),
        lines.alias("lines"),
        F.regexp_count("text_", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text_", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text_", F.lit(r"[\p{L}\p{N}]")).cast("long").alias("n_letters"),
        F.regexp_count("text_", F.lit("[!|{}]")).cast("long").alias("n_marks"),
    )
    windows = F.when(
        F.size("w") >= 3,
        F.transform(
            F.slice("w", F.lit(1), F.size("w") - 2), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))
        ),
    ).otherwise(F.array().cast("array<long>"))
    counted = base.select(
        *keep,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
        "n_letters",
        "n_marks",
        windows.alias("h"),
    )
    return _repeat_words(counted).drop("h")


def _repeat_words(counted: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows whose hash ``h`` occurs again in the text.

    Sorting (hash, place) pairs brings equal windows together, but only plain numbers
    sort fast. So a window's place, which always fits PLACE_BITS, takes the low bits of
    its hash, and neighbours in that order are compared by their whole hashes. That is
    exact as long as no two different windows of a text agree in the high bits; where
    two do, pairs are sorted after all.
    """
    mask = (1 << PLACE_BITS) - 1
    packed = F.sort_array(F.transform("h", lambda x, i: x.bitwiseAND(~mask).bitwiseOR(i.cast("long"))))

    def hash_of(x: Column) -> Column:
        return F.get("h", x.bitwiseAND(mask).cast("int"))

    def high(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def beside(name: str, test: Callable[[Column, Column], Column]) -> Column:
        """The elements of an array that pass with the one before or behind."""
        at = lambda i: F.get(name, i)
        return F.filter(
            name, lambda x, i: F.coalesce(F.when(i > 0, test(x, at(i - 1))), F.lit(False)) | F.coalesce(test(x, at(i + 1)), F.lit(False))
        )

    repeats = F.size("h") > F.size(F.array_distinct("h"))
    step = counted.withColumn("packed", F.when(repeats, packed))
    clash = F.size(beside("packed", lambda x, y: (high(x) == high(y)) & (hash_of(x) != hash_of(y)))) > 0
    step = step.withColumn(
        "pairs", F.when(clash, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("hash"), i.alias("place")))))
    )
    by_pairs = F.transform(beside("pairs", lambda x, y: x["hash"] == y["hash"]), lambda x: x["place"].cast("long"))
    by_packed = F.transform(
        beside("packed", lambda x, y: (high(x) == high(y)) & (hash_of(x) == hash_of(y))), lambda x: x.bitwiseAND(mask)
    )
    step = step.withColumn("places", F.sort_array(F.when(F.col("pairs").isNotNull(), by_pairs).otherwise(by_packed)))
    covered = F.aggregate(
        F.transform("places", lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("places", i + 1) - x, F.lit(3).cast("long")))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("packed", "pairs", "places")


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """Votes good below ``good`` and bad above ``bad`` on ``value``; abstains between, and where ``value`` is null."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        v = self.value
        return F.when(v <= self.good, 1).when(v > self.bad, -1).otherwise(0).cast("byte")


def rules() -> list[Rule]:
    n = F.col("n_words")
    share = lambda c, of: F.when(of > 0, c / of)
    word = share(F.col("word_chars"), n)
    return [
        Rule("words_too_few", F.lit(100.0) - n, 20.0, 50.0),
        Rule("word_length", F.abs(word - 6.0), 2.5, 6.0),
        Rule("letters", share(F.col("word_chars") - F.col("n_letters"), F.col("word_chars")), 0.08, 0.12),
        Rule("symbols", share(F.col("n_symbols"), n), 0.05, 0.2),
        Rule("repeated_lines", F.when(F.col("n_lines") >= 2, F.col("n_dup_lines") / F.col("n_lines")), 0.05, 0.3),
        Rule("repeated_words", share(F.col("n_repeat_words"), n), 0.1, 0.3),
        Rule("capitals", share(F.col("n_upper"), F.col("n_letters")), 0.2, 0.5),
        Rule("marks", share(F.col("n_marks"), n), 0.03, 0.2),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# ---------------------------------------------------------------- expectation-maximisation


@dataclass(frozen=True)
class Fit:
    """The share of good documents, and how each rule votes on either kind.

    ``rates[j][y][v + 1]`` is the share of documents of kind ``y`` (0 bad, 1 good) on
    which rule ``j`` votes ``v``. A single accuracy would let a rule's common approval
    of anything without its one defect outweigh the rare finding of that defect.
    """

    prior: float
    rates: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    def weight(self, j: int, vote: int) -> float:
        bad, good = self.rates[j]
        return math.log(good[vote + 1] / bad[vote + 1])

    def log_odds(self, votes: Sequence[int]) -> float:
        return _logit(self.prior) + sum(self.weight(j, v) for j, v in enumerate(votes))

    def accuracy(self, j: int) -> float:
        """How often rule ``j`` is right when it votes."""
        bad, good = self.rates[j]
        right = self.prior * good[2] + (1 - self.prior) * bad[0]
        return right / (right + self.prior * good[0] + (1 - self.prior) * bad[2])


#: Where EM starts: how rules vote (-1, 0, 1) on bad and on good documents.
START = ((0.3, 0.2, 0.5), (0.02, 0.18, 0.8))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(patterns: Sequence[tuple[Sequence[int], int]], rounds: int = 500, start: float = 0.8, weight: float = 4.0) -> Fit:
    """EM over (votes, number of documents).

    What tells good from bad without labels is that a rule objects to a bad document at
    least as often as to a good one, and approves at most as often; a rule for which EM
    finds otherwise loses that part of its say. ``weight`` documents that vote as in
    START are added to either kind, so that a rule that never votes, or an empty table,
    leaves the start values.
    """
    if not patterns:
        return Fit(start, ())
    k = len(patterns[0][0])
    now = Fit(start, (START,) * k)
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        shared = [(_sigmoid(now.log_odds(v)), v, n) for v, n in patterns]
        n_good = sum(p * n for p, _, n in shared)
        rates = []
        for j in range(k):
            seen = [[weight * x for x in kind] for kind in START]
            for p, v, n in shared:
                seen[0][v[j] + 1] += (1 - p) * n
                seen[1][v[j] + 1] += p * n
            bad, good = ([x / sum(kind) for x in kind] for kind in seen)
            if bad[0] < good[0] or good[2] < bad[2]:
                bad = good = [(x + y) / (sum(seen[0]) + sum(seen[1])) for x, y in zip(*seen, strict=True)]
            rates.append((tuple(bad), tuple(good)))
        then = Fit(min(0.99, max(0.01, (n_good + weight * start) / (total + weight))), tuple(rates))
        moved = abs(then.prior - now.prior)
        now = then
        if moved < 1e-10:
            break
    return now


# ---------------------------------------------------------------- the operator


def judge(docs: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """Counts, votes and verdict of each row of ``docs`` (doc_id, text).

    Gives doc_id, the counts of ``text_counts``, base_failed (under 50 words, or over
    half of them in repeated windows), a ``vote_`` column for each rule, posterior (that
    the text is good) and kept: false where base_failed, else whether the posterior
    reaches ``keep_at``. A null text counts as empty; on an empty text all rules but the
    one on length abstain. Repeated rows stay, and vote each. Other columns are not looked at.
    """
    every = rules()
    votes = [f"vote_{r.name}" for r in every]
    counts = text_counts(docs, "doc_id")
    voted = stored(counts.select("*", *(r.vote().alias(v) for r, v in zip(every, votes, strict=True))), "votes")
    patterns = voted.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # at most 3 to the number of rules
    fitted = fit(sorted((tuple(r[v] for v in votes), r["n"]) for r in patterns))  # in one order, so that sums come out alike
    odds = F.lit(_logit(fitted.prior))
    for j, v in enumerate(votes if fitted.rates else ()):
        by_vote = {w: F.lit(fitted.weight(j, w)) for w in (-1, 0, 1)}
        odds = odds + F.when(F.col(v) < 0, by_vote[-1]).when(F.col(v) > 0, by_vote[1]).otherwise(by_vote[0])
    posterior = 1 / (1 + F.exp(-odds))
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("posterior", posterior)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))
    )
