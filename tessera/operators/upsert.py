"""Writes without MERGE: new images of tables, to be written as a version and swapped in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import best_row


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], last: Sequence[Column] = ()) -> DataFrame:
    """``target`` with ``changes`` merged in by key (K1).

    Only columns that ``changes`` has are touched; a new key has null in the others.
    Of changes with the same key the first in the order ``last`` counts; without one, and among
    equals in it, the one with the greatest values, column by column, so that a rerun gives the
    same rows. Changes that have nothing but the key insert what is missing and touch nothing.
    """
    given = [c for c in target.columns if c in changes.columns and c not in keys]
    orderable = [F.to_json(c) if isinstance(changes.schema[c].dataType, T.MapType) else F.col(c) for c in given]
    order = [*last, *(c.desc_nulls_last() for c in orderable)]
    source = best_row(changes, keys, order) if order else changes.dropDuplicates(list(keys))
    s = source.select(*keys, F.lit(True).alias("_there"), *(F.col(c).alias(f"_new_{c}") for c in given))
    joined = target.join(s, list(keys), "full_outer")
    return joined.select(
        *(
            F.when(F.col("_there"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
            for c in target.columns
        )
    )


def replace_where(target: DataFrame, replaced: Column, rows: DataFrame) -> DataFrame:
    """``target`` with the rows that meet ``replaced`` deleted and ``rows`` put in (K2, K3)."""
    return target.where(~F.coalesce(replaced, F.lit(False))).unionByName(rows.select(*target.columns))


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces exactly the partitions that ``df`` has rows of (K3)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def drop_stale(target: DataFrame, kept: DataFrame, keys: Sequence[str], scope: Column) -> DataFrame:
    """Rows in ``scope`` go unless ``kept`` has their key; rows out of it stay (K4)."""
    inside = target.where(scope).join(kept.select(*keys).distinct(), list(keys), "left_semi")
    return target.where(~F.coalesce(scope, F.lit(False))).unionByName(inside)


def null_dangling(df: DataFrame, reference: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """References to parents that are no longer there become null (K4)."""
    there = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return df.join(there, F.col(reference) == F.col("_parent"), "left").withColumn(reference, F.col("_parent")).drop("_parent")


def insert_or_update(target: DataFrame, rows: DataFrame, keys: Sequence[str], keep_old: Sequence[str]) -> DataFrame:
    """Upsert of whole rows in which ``keep_old`` columns keep their first value (K7)."""
    old = target.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in keep_old))
    merged = upsert(target, rows, keys)
    return merged.join(old, list(keys), "left").select(
        *(F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep_old else F.col(c) for c in target.columns)
    )
