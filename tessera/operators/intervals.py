"""Validity intervals: combining, merging sources by rank, closing by successors, and who held what when.

An interval has a start, an end (null: open) and a source. Ends from an *observing* source
are the last day a thing was seen, not the day it ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.aggregates import open_end


def combine(df: DataFrame, keys: Sequence[str], start: str, end: str, carry: Sequence[str] = ()) -> DataFrame:
    """One interval a key: earliest start, latest end, open if any is open; ``carry`` from the earliest."""
    return df.groupBy(*keys).agg(
        F.min(start).alias(start),
        open_end(F.col(end)).alias(end),
        *(F.min_by(c, start).alias(c) for c in carry),
    )


def rank_of(source: str, order: Sequence[str]) -> Column:
    """Place in ``order``; what is not in it comes last."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(source))
    return F.when(at > 0, at).otherwise(len(order) + 1)


def merge_by_rank(df: DataFrame, keys: Sequence[str], source: str, order: Sequence[str], take: Sequence[str], other_order: Sequence[str] = (), other_take: Sequence[str] = ()) -> DataFrame:
    """Of several sources of a key, the columns ``take`` from the best in ``order``, ``other_take`` from the best in another order.

    One row of each source and key is expected (``combine`` first).
    """
    out = [F.min_by(F.struct(source, *take), rank_of(source, order)).alias("_a")]
    if other_take:
        out.append(F.min_by(F.struct(*other_take), rank_of(source, other_order)).alias("_b"))
    merged = df.groupBy(*keys).agg(*out)
    return merged.select(
        *keys,
        F.col(f"_a.{source}").alias(source),
        *(F.col(f"_a.{c}").alias(c) for c in take),
        *(F.col(f"_b.{c}").alias(c) for c in other_take),
    )


def close_by_successor(rows: DataFrame, later: DataFrame, office: Sequence[str], holder: str, start: str, end: str) -> DataFrame:
    """Open intervals end the day before another holder of the same office first appears after their start.

    ``later`` has the appearances: office, holder, start. Adds ``successor`` (null if none, or
    if the interval has an end). One pass over each office from its last day to its first,
    in which an interval meets the appearances after it; an office's rows are sorted once,
    and no interval is paired with all appearances of its office.
    """
    appearance = F.struct(F.col(start).alias("from"), F.col(holder).alias("who"))
    given = F.lit(True)
    for c in (*office, holder, start):
        given = given & F.col(c).isNotNull()
    seen = later.where(given).select(*office, F.col(start).alias("_day"), appearance.alias("_seen"))
    all_rows = rows.withColumns({"_day": F.col(start), "_interval": F.lit(True)}).unionByName(seen, allowMissingColumns=True)
    # Of one day the intervals come first, so that only later days have been passed.
    back = Window.partitionBy(*office).orderBy(F.col("_day").desc_nulls_last(), F.col("_interval").desc_nulls_last(), F.col("_seen.who").desc())
    passed, here = back.rowsBetween(Window.unboundedPreceding, -1), back.rowsBetween(Window.unboundedPreceding, 0)
    met = all_rows.withColumn("_next", F.last("_seen", ignorenulls=True).over(passed))
    # Where the holder changes, the appearance behind the change is the next one of somebody else.
    change = F.when(F.col("_seen").isNotNull() & (F.col("_next.who") != F.col("_seen.who")), F.col("_next"))
    met = met.withColumn("_other", F.last(change, ignorenulls=True).over(here)).where("_interval")
    known = F.col(end).isNull() & F.col(start).isNotNull() & F.col(holder).isNotNull()
    of_another = F.when(F.col("_next.who") == F.col(holder), F.col("_other")).otherwise(F.col("_next"))
    return met.withColumn("_next", F.when(known, of_another)).select(
        *(c for c in rows.columns if c != end),
        F.coalesce(F.col(end), F.date_sub(F.col("_next.from"), 1)).alias(end),
        F.col("_next.who").alias("successor"),
    )


def held_on(rows: DataFrame, on: Column, row_id: str, holder: str, office: Sequence[str], single: Column, observed: Column, start: str, end: str) -> DataFrame:
    """Intervals held on a day.

    Held from ``start`` to ``end`` or open; and, if ``observed`` (its end is only the last
    sighting), after that too unless contradicted by then: by a later interval of the same
    holder, or, where ``single`` (the office has one holder at a time), of the same office.
    """
    day = rows.withColumns({"_on": on, "_single": single, "_observed": observed}).where(F.col(start) <= F.col("_on"))
    plain = F.col(end).isNull() | (F.col(end) >= F.col("_on"))
    doubtful = day.where(~plain & F.col("_observed"))
    later = lambda c: day.select(F.col(row_id).alias("_other"), F.col(start).alias("_start"), *(F.col(x).alias(f"_{x}") for x in c))
    between = (F.col(end) < F.col("_start")) & (F.col(row_id) != F.col("_other"))
    same_holder = doubtful.join(later([holder]), (F.col(holder) == F.col(f"_{holder}")) & between, "left_anti")
    same_office = F.col("_single")
    for c in office:
        same_office = same_office & F.col(c).eqNullSafe(F.col(f"_{c}"))
    still = same_holder.join(later(office), same_office & between, "left_anti")
    return day.where(plain).unionByName(still).drop("_on", "_single", "_observed")


def stale(rows: DataFrame, newest: DataFrame, end: str, days: int) -> DataFrame:
    """Rows last seen more than ``days`` before the one day of ``newest`` (column ``newest``); none without a day (Q7).

    ``newest`` is a global aggregate: one row, joined to all.
    """
    return (
        rows.join(F.broadcast(newest.where("newest is not null")))
        .where(F.col(end) < F.date_sub("newest", days))
        .withColumn("days_since_seen", F.datediff("newest", end))
    )
