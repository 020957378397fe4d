"""Invariants and data-quality checks: keys, references, snapshots and their differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table (A19): one aggregate each, united; counts come from file footers where they can."""
    each = [d.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, d in tables.items()]
    return reduce(DataFrame.unionByName, each)


def snapshot_diff(before: DataFrame, now: DataFrame, key: str, value: str, most_loss: float = 0.05) -> DataFrame:
    """Counts then and now (A20): gone, empty, or smaller by more than ``most_loss`` fails."""
    b = before.select(key, F.col(value).alias("n_before"))
    n = now.select(key, F.col(value).alias("n_now"))
    lost = F.col("n_now") < F.col("n_before") * (1 - most_loss)
    gone = F.col("n_now").isNull() & F.col("n_before").isNotNull()
    emptied = (F.col("n_now") == 0) & (F.col("n_before") > 0)
    return b.join(n, key, "full_outer").withColumn("failed", F.coalesce(gone | emptied | lost, F.lit(False)))


def problem_rises(before: DataFrame, now: DataFrame, limits: Mapping[str, int | None]) -> DataFrame:
    """Problem counts (problem, n) that rise by more than their limit fail; a null limit only reports."""
    limit = F.create_map(*(x for k, v in limits.items() for x in (F.lit(k), F.lit(v).cast("long"))))
    b, n = (d.select("problem", F.col("n").alias(to)) for d, to in ((before, "n_before"), (now, "n_now")))
    rise = F.coalesce("n_now", F.lit(0)) - F.coalesce("n_before", F.lit(0))
    return b.join(n, "problem", "full_outer").withColumns(
        {"rise": rise, "failed": F.coalesce(rise > F.try_element_at(limit, F.col("problem")), F.lit(False))}
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, reference: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference is not null and points nowhere."""
    return df.where(F.col(reference).isNotNull()).join(parent.select(F.col(parent_key).alias(reference)).distinct(), reference, "left_anti")


def unreferenced(parent: DataFrame, key: str, references: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows of ``parent`` that no (table, column) points to."""
    used = reduce(DataFrame.unionByName, [d.select(F.col(c).alias(key)).where(F.col(key).isNotNull()) for d, c in references])
    return parent.join(used.distinct(), key, "left_anti")


def not_in(df: DataFrame, column: str, values: DataFrame, other: str) -> DataFrame:
    """NOT IN with SQL's nulls (F5): nothing passes if ``values`` has a null, and a null passes only if it is empty.

    The nulls are found by a one-row aggregate; the rest is an ordinary anti join, which
    shuffles, where a null-aware one would have to broadcast the values.
    """
    facts = values.agg(F.count("*").alias("_n"), F.count_if(F.col(other).isNull()).alias("_nulls"))
    passed = df.join(values.select(F.col(other).alias(column)), column, "left_anti")
    ok: Column = (F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())
    return passed.join(F.broadcast(facts)).where(ok).select(*df.columns)
