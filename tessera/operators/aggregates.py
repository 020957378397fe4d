"""Aggregates that need an explicit tie-break, null rule or order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Rows of each key and value (A2); of rows that are counts themselves, the sum of ``weight``."""
    return df.groupBy(*keys, value).agg((F.sum(weight) if weight else F.count("*")).alias("n"))


def majority(df: DataFrame, keys: Sequence[str], value: str, to: str, counts_to: str | None = None, weight: str | None = None) -> DataFrame:
    """The most frequent ``value`` of each key, the smaller one of a tie (A9), and all counts as ``value:n`` in order.

    Two aggregations that both sum up before their shuffles: no key's rows meet in one task.
    """
    n = value_counts(df, keys, value, weight)
    out = [F.min_by(F.col(value), F.struct(-F.col("n"), F.col(value))).alias(to)]
    if counts_to:
        pairs = F.sort_array(F.collect_list(F.struct(value, "n")))  # as many as there are values
        out.append(F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p[value], p["n"])), ",").alias(counts_to))
    return n.groupBy(*keys).agg(*out)


def most_common(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], to: str) -> DataFrame:
    """The most frequent ``value`` of each key; of equals the one that is met first in ``order``.

    Two aggregations that both sum up before their shuffles, as in ``majority``.
    """
    n = df.groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_first"))
    return n.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col("_first"))).alias(to))


def pivot_counts(df: DataFrame, keys: Sequence[str], value: str, values: Sequence[str], prefix: str = "n_") -> DataFrame:
    """One count column for each of ``values`` (A10): conditional counts in one pass, no pivot job."""
    return df.groupBy(*keys).agg(*(F.count_if(F.col(value) == v).alias(f"{prefix}{v}") for v in values))


def open_end(end: Column) -> Column:
    """The latest of the ends, null (open) if any is null."""
    return F.when(F.count_if(end.isNull()) > 0, F.lit(None)).otherwise(F.max(end))


def only_value(value: Column) -> Column:
    """The value if the group has exactly one distinct value, else null."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def listing(order: Sequence[Column], item: Column, sep: str = ",") -> Column:
    """The group's items joined in ``order`` (A11); for groups that are small by their nature."""
    named = [o.alias(f"o{k}") for k, o in enumerate(order)]
    rows = F.sort_array(F.collect_list(F.struct(*named, item.alias("item"))))
    return F.array_join(F.transform(rows, lambda r: r["item"]), sep)


def completeness(n: Column, n_done: Column) -> Column:
    """unanswered, failed, partial or complete, by how many of ``n`` parts are done."""
    return (
        F.when(n == 0, "unanswered").when(n_done == 0, "failed").when(n_done < n, "partial").otherwise("complete")
    )
