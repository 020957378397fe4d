"""One row of many: latest copies, first and last wins, distinct suffixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in ``order``.

    Spark's window-group limit keeps one row of a key per task before the shuffle, so a
    hot key costs a row from each task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def latest(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """Of overlapping copies, the one with the greatest ``newest`` columns."""
    return best_row(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def first_of_sources(sources: Sequence[DataFrame], keys: Sequence[str], within: Sequence[Column] = ()) -> DataFrame:
    """Union by name where the earliest source that has a key wins."""
    ranked = [s.withColumn("_source", F.lit(k)) for k, s in enumerate(sources)]
    union = ranked[0]
    for s in ranked[1:]:
        union = union.unionByName(s, allowMissingColumns=True)
    return best_row(union, keys, [F.col("_source"), *within]).drop("_source")


def suffixed(df: DataFrame, base: str, order: Sequence[Column], to: str) -> DataFrame:
    """``base``, then ``base-2``, ``base-3`` for its repetitions in ``order``."""
    nth = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    return df.withColumn(to, F.when(nth == 1, F.col(base)).otherwise(F.concat_ws("-", F.col(base), nth.cast("string"))))


def distinct_in_order(values: Column) -> Column:
    """Array without repetitions, first occurrences in place."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull()))
