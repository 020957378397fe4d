"""One-to-one assignments: the best one of small groups, and greedy by distance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rounds import ROWS, cut, dealt


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def best_assignment(pairs: DataFrame, keys: Sequence[str], a: str, b: str, score: str, most: int = 4, margin: float = 0.2) -> DataFrame:
    """The one-to-one assignment of ``a`` to ``b``, as many as the smaller side has, with the greatest total score.

    ``pairs`` has every pair of a group with its score. Document order (k-th with k-th)
    stays unless another assignment beats it by more than ``margin``; of equal ones the
    first by places counts. Groups of more than ``most`` on a side keep document order
    as far as both go. A group is one asker's questions of a document: small by its nature.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        left, right = sorted(g[a].unique()), sorted(g[b].unique())
        n = min(len(left), len(right))
        table = {(x, y): s for x, y, s in zip(g[a], g[b], g[score], strict=True)}
        best = list(zip(left, right, strict=False))
        if n and max(len(left), len(right)) <= most:
            total = lambda links: sum(table.get(x, 0.0) for x in links)
            # Each choice of the left side in its order, with every order of the right: all assignments, each once.
            orders = (list(zip(x, y, strict=True)) for x in combinations(left, n) for y in permutations(right, n))
            other = max(orders, key=total)
            if total(other) > total(best) + margin:
                best = other
        rows = [(*(g[k].iloc[0] for k in keys), x, y) for x, y in best]
        return pd.DataFrame(rows, columns=[*keys, a, b])

    return pairs.groupBy(*keys).applyInPandas(run, _ddl(pairs, [*keys, a, b]))


def greedy(pairs: DataFrame, keys: Sequence[str], a: str, b: str, distance: str) -> DataFrame:
    """Pairs taken by growing distance, each side once; ties by ``a``, then ``b``.

    In each round every pair goes that is the least of both its ends: no other pair could have taken either end
    before it. What its ends had besides goes with it. That gives what taking pairs one after the other would
    give, whatever the number of rows of a key; rounds are as many as the longest run of pairs
    that hang on each other. Ends are summed up before they are shuffled. Pairs with a null distance are never taken,
    repeated ones once. There may be far more pairs than rows: they are dealt so that a task has some ROWS of them at most.
    """
    left = cut(pairs.select(*keys, a, b, distance).where(F.col(distance).isNotNull()))
    taken = None
    while n := left.count():
        if n > ROWS * left.rdd.getNumPartitions() or taken is None:
            left = cut(dealt(left, n, *keys, a, b))
        of_a = left.groupBy(*keys, a).agg(F.min(F.struct(F.col(distance), F.col(b))).alias("_least"))
        of_b = left.groupBy(*keys, b).agg(F.min(F.struct(F.col(distance), F.col(a))).alias("_least"))
        of_a = of_a.select(*keys, a, F.col("_least")[b].alias(b), F.col("_least")[distance].alias(distance))
        of_b = of_b.select(*keys, F.col("_least")[a].alias(a), b)
        now = cut(_same(of_a, of_b, [*keys, a, b]))
        taken = now if taken is None else taken.unionByName(now)
        rest = _same(left, now.select(*keys, a).distinct(), [*keys, a], "left_anti")
        left = cut(_same(rest, now.select(*keys, b).distinct(), [*keys, b], "left_anti"))
    return left if taken is None else taken


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` with (or without) a row of ``right`` that has the same ``columns``, nulls included."""
    x, y = left.alias("x"), right.alias("y")
    on = reduce(lambda p, q: p & q, [F.col(f"x.`{c}`").eqNullSafe(F.col(f"y.`{c}`")) for c in columns])
    return x.join(y, on, how)
