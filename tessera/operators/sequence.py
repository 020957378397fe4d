"""Operators over ordered rows: islands, clusters, carried values, running counts, blocks, interruptions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(keys: Sequence[str], order: Sequence[str | Column]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, to: str = "part") -> DataFrame:
    """Numbers the runs of one ``value``, from 1."""
    w = _ordered(keys, order)
    starts = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("long")
    return df.withColumn("_starts", starts).withColumn(to, F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_starts")


def chained(df: DataFrame, keys: Sequence[str], value: str, gap: Column, to: str) -> DataFrame:
    """Numbers the clusters of ``value``, from 1: a gap of more than ``gap`` to the next smaller value begins one."""
    w = _ordered(keys, [value])
    # Rows of one value begin no cluster of their own, in whatever order they come.
    starts = F.coalesce(F.col(value) - F.lag(value).over(w) > gap, F.lit(True)).cast("long")
    return df.withColumn("_starts", starts).withColumn(to, F.sum("_starts").over(w.rangeBetween(Window.unboundedPreceding, 0))).drop("_starts")


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, to: str) -> DataFrame:
    """The last value that is not null, up to the row itself."""
    w = _ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(to, F.last(value, ignorenulls=True).over(w))


def count_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column, to: str) -> DataFrame:
    """How many earlier rows meet ``condition``."""
    w = _ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(to, F.count_if(condition).over(w))


def interleaved(streams: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str], to: str = "position") -> DataFrame:
    """Several streams as one, in the order of shared columns, the earlier stream first at a tie."""
    union = None
    for k, s in enumerate(streams):
        s = s.withColumn("_stream", F.lit(k))
        union = s if union is None else union.unionByName(s, allowMissingColumns=True)
    return union.withColumn(to, F.row_number().over(_ordered(keys, [*order, "_stream"]))).drop("_stream")


def blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], opens: Column, least: int = 2, to: str = "block") -> DataFrame:
    """Rows from each opening on, numbered from 1; keys with fewer than ``least`` openings have no blocks."""
    w = _ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    n = F.count_if("_opens").over(Window.partitionBy(*keys))
    marked = df.withColumn("_opens", opens)
    return marked.withColumns({to: F.count_if("_opens").over(w), "_n": n}).where((F.col(to) > 0) & (F.col("_n") >= least)).drop("_opens", "_n")


def context(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, n: int, to: str) -> DataFrame:
    """The values of the last ``n`` rows, the row itself included."""
    return df.withColumn(to, F.collect_list(value).over(_ordered(keys, order).rowsBetween(-(n - 1), 0)))


def lookahead(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, to: str) -> DataFrame:
    """The value ``n`` rows on."""
    return df.withColumn(to, F.lead(value, n).over(_ordered(keys, order)))


def folded(df: DataFrame, keys: Sequence[str], order: Sequence[str], take: Sequence[str], start: Column, step: Callable[[Column, Column], Column]) -> DataFrame:
    """A state machine over the ordered rows of a key (W8-W10): the keys, and state, what ``step(state, row)`` makes of ``start`` row by row.

    For what no window can say, as each step depends on the one before. A key's rows become one array: the
    turns of an item, a few hundred at most.
    """
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, *(c for c in take if c not in order)))).alias("_rows"))
    return rows.select(*keys, F.aggregate("_rows", start, step).alias("state"))


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], to: str = "position") -> DataFrame:
    """Row numbers from 1."""
    return df.withColumn(to, F.row_number().over(_ordered(keys, order)).cast("long"))


def interruptions(parts: DataFrame, speech: str, order: str, speaker: str, part_id: str, words: str, announced: str, least_words: int = 30) -> DataFrame:
    """Who interrupts the main speaker of a printed speech, of what kind, and from which part on.

    The first speaker is the main one. Another's part right after a part of the main
    speaker begins a new interruption if that person has none yet or the main speaker has
    since said ``least_words`` words; else it goes on with the person's last one. Its kind
    depends on ``announced``, whether the part before it announces a short intervention. A
    part right after another interruption goes on with the person's own or is a question.
    Adds interruption and interruption_start, null on the main speaker's parts. Parts at one place are taken by their ids.

    The words that count are those of the main speaker's parts right before, so running
    sums, islands and the last beginning of the same person say it all: windows over one order.
    """
    by = [order, part_id]
    w = _ordered([speech], by)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    mains = F.first(speaker).over(upto)
    df = parts.withColumn("_main", F.col(speaker).eqNullSafe(mains))
    df = df.withColumn("_said", F.sum(F.when(F.col("_main"), F.coalesce(F.col(words).cast("long"), F.lit(0))).otherwise(0)).over(upto))
    # Said up to the last part of someone else: what came after it is the main speaker's run.
    df = df.withColumn("_before", F.coalesce(F.last(F.when(~F.col("_main"), F.col("_said")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    df = df.withColumns({
        "_after_main": F.lag("_main").over(w),
        "_told": F.coalesce(F.lag(F.col(announced).cast("boolean")).over(w), F.lit(False)),
        "_known": F.row_number().over(_ordered([speech, speaker], by)) > 1,
    })
    begins = ~F.col("_main") & (~F.col("_known") | (F.col("_after_main") & (F.col("_said") - F.col("_before") >= least_words)))
    kind = F.when(F.col("_after_main") & F.col("_told"), "kurzintervention").otherwise("zwischenfrage")
    df = df.withColumn("_begun", F.when(begins, F.struct(kind.alias("kind"), F.col(part_id).alias("start"))))
    own = F.last("_begun", ignorenulls=True).over(_ordered([speech, speaker], by).rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_own", F.when(~F.col("_main"), own))
    return df.select(*parts.columns, F.col("_own.kind").alias("interruption"), F.col("_own.start").alias("interruption_start"))
