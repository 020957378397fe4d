"""Joins beyond equality: as-of, interval, nearest, tolerance, positional, cascades and precedence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.rounds import dealt


def lookup(df: DataFrame, dimension: DataFrame, keys: Sequence[str], last: Sequence[Column], how: str = "left") -> DataFrame:
    """Join to a dimension that may repeat a key: its last row in the order of ``last`` counts.

    Without the dedup a repeated key would multiply rows. Whether the dimension is
    broadcast is left to Spark, which looks at its size.
    """
    from tessera.operators.dedup import best_row

    return df.join(best_row(dimension, keys, last), list(keys), how)


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, take: Sequence[str], forward: bool = False, strict: bool = False) -> DataFrame:
    """Each left row with the last right row at or before it (``forward``: the first at or after it; ``strict``: not at it) of its key.

    One union and one window over a sort: no row meets more than its neighbours, however
    many events a key has, and both sides are read once.
    """
    value = F.struct(*(F.col(c) for c in take))
    kind = left.select(*left.columns).schema
    # At the same moment right rows come first, unless they must not count.
    side = F.col("_side").desc() if strict else F.col("_side")
    lefts = left.withColumn("_right", F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType))
    rights = right.select(*(F.col(c) for c in keys), F.col(at), value.alias("_right"))
    for f in kind:
        if f.name not in (*keys, at):
            rights = rights.withColumn(f.name, F.lit(None).cast(f.dataType))
    both = lefts.withColumn("_side", F.lit(1)).unionByName(rights.withColumn("_side", F.lit(0)))
    order = [F.col(at).desc() if forward else F.col(at), side]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    return seen.select(*left.columns, *(F.col(f"_found.{c}").alias(c) for c in take))


def asof_in_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, take: Sequence[str], bucket: Column) -> DataFrame:
    """As ``asof``, for keys that may hold a large share of all rows: a key's rows are cut into buckets of ``at``.

    ``bucket`` is a growing function of ``at``. A row finds its match in its own bucket, or
    else what an earlier bucket of its key ended with; that second search runs over one row a
    key and bucket, which are summed up before they are shuffled.
    """
    inside = asof(left.withColumn("_bucket", bucket), right.withColumn("_bucket", bucket), [*keys, "_bucket"], at, take)
    ends = right.withColumn("_bucket", bucket).groupBy(*keys, "_bucket").agg(F.max_by(F.struct(*take), at).alias("_last"))
    asked = left.select(*keys, bucket.alias("_bucket")).distinct()
    before = asof(asked, ends, keys, "_bucket", ["_last"], strict=True)
    same = [inside[c].eqNullSafe(before[c]) for c in (*keys, "_bucket")]
    found = inside.join(before.where("_last IS NOT NULL"), reduce(lambda a, b: a & b, same), "left")
    taken = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in take])
    return found.select(*(inside[c] for c in left.columns), *(F.when(taken, F.col(c)).otherwise(F.col("_last")[c]).alias(c) for c in take))


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_id: str, distance) -> DataFrame:
    """Each left row with the right row of its key that is nearest in ``at``; of two as near, the smaller id.

    Only the last before and the first after can be nearest, so two as-of joins do.
    ``distance(a, b)`` gives the non-negative distance of two positions.
    """
    r = right.select(*keys, at, F.col(right_id).alias("_id"), F.col(at).alias("_at"))
    before = asof(left, r, keys, at, ["_id", "_at"]).withColumnsRenamed({"_id": "_id0", "_at": "_at0"})
    both = asof(before, r, keys, at, ["_id", "_at"], forward=True)
    sides = [
        F.when(F.col(i).isNotNull(), F.struct(distance(F.col(p), F.col(at)).alias("distance"), F.col(i).alias("id")))
        for i, p in (("_id0", "_at0"), ("_id", "_at"))
    ]
    best = F.least(*sides)
    return both.select(*left.columns, best["id"].alias(right_id), best["distance"].alias("distance"))


#: A span of days is cut into blocks of 1, BASE, BASE**2 … days; LEVELS of them reach beyond the year 9999.
BASE, LEVELS = 16, 6


def _floor(x: Column, width: int) -> Column:
    return F.floor(x / F.lit(width)).cast("long")


def _at_level(level: int, block: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), block.alias("block"))


def day_blocks(first: Column, last: Column) -> Column:
    """The fewest whole blocks that make up the days from ``first`` to ``last``, as (level, block); fewer than 2 * BASE a level."""
    ranges = []
    for k in range(LEVELS):
        width, above = BASE**k, BASE ** (k + 1)
        a, b = -_floor(-first, width), _floor(last + 1, width)
        upper_a, upper_b = -_floor(-first, above) * BASE, _floor(last + 1, above) * BASE
        inner = (upper_a < upper_b) & F.lit(k + 1 < LEVELS)  # what larger blocks cover
        for start, end in ((a, F.when(inner, upper_a).otherwise(b)), (F.when(inner, upper_b).otherwise(b), b)):
            blocks = F.when(start < end, F.sequence(start, F.greatest(end - 1, start))).otherwise(F.array().cast("array<bigint>"))
            ranges.append(F.transform(blocks, partial(_at_level, k)))
    return F.concat(*ranges)


def covering(facts: DataFrame, intervals: DataFrame, keys: Sequence[str], on: str, start: str, end: str) -> DataFrame:
    """Facts with each interval of their key that covers ``on``, dates or moments; a null end is open.

    An interval becomes the few blocks of days, of several widths, that make it up, a fact the
    one block of each width that holds its day; they meet by equality, so a key's facts meet
    only intervals of their day, and a key with many rows is dealt by its blocks. Moments are compared after that.
    Blocks are never broadcast: Spark sees the size of the intervals, not of the blocks that they become. An open end
    is where the widest blocks end, so that it adds no narrow ones.
    """
    day = lambda c: F.unix_date(F.to_date(c)).cast("long")
    last = F.coalesce(day(F.col(end)), F.lit(BASE**LEVELS - 1).cast("long"))
    cut = intervals.withColumn("_at", F.explode(day_blocks(day(F.col(start)), last)))
    held = [_at_level(k, _floor(day(F.col(on)), BASE**k)) for k in range(LEVELS)]
    met = facts.withColumn("_at", F.explode(F.array(*held))).join(cut.hint("merge"), [*keys, "_at"]).drop("_at")
    return met.where((F.col(start) <= F.col(on)) & (F.col(end).isNull() | (F.col(on) <= F.col(end))))


def latest_covering(facts: DataFrame, intervals: DataFrame, keys: Sequence[str], fact_id: Sequence[str], on: str, start: str, end: str) -> DataFrame:
    """As ``covering``, the interval that starts last for each fact."""
    from tessera.operators.dedup import best_row

    return best_row(covering(facts, intervals, keys, on, start, end), fact_id, [F.col(start).desc()])


def positional(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str], left_take: Sequence[str], right_take: Sequence[str]) -> DataFrame:
    """The k-th left with the k-th right row of a key, where both sides have equally many."""

    def numbered(df: DataFrame, order: Sequence[str], take: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*keys)
        return df.select(
            *keys,
            F.row_number().over(w.orderBy(*order)).cast("long").alias("k"),
            F.count("*").over(w).alias("_n"),
            *take,
        )

    a, b = numbered(left, left_order, left_take), numbered(right, right_order, right_take)
    return a.join(b, [*keys, "k", "_n"]).drop("_n")


def within_tolerance(left: DataFrame, right: DataFrame, keys: Sequence[str], a: str, b: str, tolerance: float) -> DataFrame:
    """Pairs of a key whose ``a`` and ``b`` differ by at most ``tolerance`` (J17's candidates).

    A band join: values fall into bands as wide as the tolerance, and a left row meets
    its own and the two neighbouring bands only, by equality. Left rows are dealt by band first: the
    pairs may be far more than the rows, which Spark would take for little work.
    """
    band = lambda c: F.floor(F.col(c) / tolerance)
    wide = left.withColumn("_band", F.explode(F.array(*(band(a) + k for k in (-1, 0, 1)))))
    wide = dealt(wide, 0, *keys, "_band")
    return wide.join(right.withColumn("_band", band(b)), [*keys, "_band"]).where(F.abs(F.col(a) - F.col(b)) <= tolerance).drop("_band")


def cascade(probes: DataFrame, probe_id: str, probe_year: str, steps: Sequence[tuple[Column, DataFrame, Column]], entity: str, year: str) -> DataFrame:
    """Tiered entity resolution (J9-J13): the first key variant with a candidate decides.

    ``steps`` are (the probe's key, the index's rows, their key), best first. A year
    narrows only where there is more than one candidate; a variant that the year empties
    is passed over; more than one left is ambiguous and gives null. Each index is summed
    up by key first, so a name that everyone bears is one row of the join, not a product.
    Gives ``probe_id``, matched_id, step (from 1; null without a candidate), n_candidates.
    """
    found = []
    for rank, (probe_key, rows, row_key) in enumerate(steps, 1):
        p = probes.select(F.col(probe_id).alias("_probe"), F.col(probe_year).alias("_probe_year"), probe_key.alias("_key"))
        by_key = rows.groupBy(row_key.alias("_key")).agg(F.count_distinct(entity).alias("_n"), F.min(entity).alias("_id"))
        by_year = rows.groupBy(row_key.alias("_key"), F.col(year).alias("_probe_year")).agg(
            F.count_distinct(entity).alias("_n_year"), F.min(entity).alias("_id_year")
        )
        met = p.join(by_key, "_key").join(by_year, ["_key", "_probe_year"], "left")
        narrowed = (F.col("_n") > 1) & F.col("_probe_year").isNotNull()
        n = F.when(narrowed, F.coalesce(F.col("_n_year"), F.lit(0))).otherwise(F.col("_n"))
        one = F.when(narrowed, F.col("_id_year")).otherwise(F.col("_id"))
        found.append(
            met.select("_probe", F.lit(rank).alias("step"), n.cast("long").alias("n_candidates"), F.when(n == 1, one).alias("matched_id")).where("n_candidates > 0")
        )
    every = reduce(DataFrame.unionByName, found)
    first = every.groupBy("_probe").agg(F.min_by(F.struct("step", "n_candidates", "matched_id"), "step").alias("_best"))
    return (
        probes.select(F.col(probe_id))
        .join(first.withColumnRenamed("_probe", probe_id), probe_id, "left")
        .select(probe_id, F.col("_best.matched_id").alias("matched_id"), F.col("_best.step").alias("step"), F.col("_best.n_candidates").alias("n_candidates"))
    )


def by_precedence(links: Sequence[tuple[str, DataFrame]], key: str, target: str) -> DataFrame:
    """Links of the best-ranked way that has any, with the way as ``via``, and the target if it is the only one."""
    ranked = reduce(
        DataFrame.unionByName,
        [d.select(key, target).distinct().withColumns({"_rank": F.lit(k), "via": F.lit(via)}) for k, (via, d) in enumerate(links)],
    )
    per_way = ranked.groupBy(key, "_rank", "via").agg(
        F.count_distinct(target).alias("n_targets"), F.when(F.min(target) == F.max(target), F.min(target)).alias(target)
    )
    return per_way.groupBy(key).agg(F.min_by(F.struct("via", "n_targets", target), "_rank").alias("_best")).select(
        key, F.col("_best.via").alias("via"), F.col("_best.n_targets").alias("n_targets"), F.col(f"_best.{target}").alias(target)
    )


def without_shared(links: DataFrame, key: str, other: str, most: int) -> DataFrame:
    """Distinct links whose ``key`` has at most ``most`` others."""
    pairs = links.select(key, other).distinct()
    crowd = pairs.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(key)
    return pairs.join(crowd, key, "left_anti")


def _prefixes(left: DataFrame, right: DataFrame, least: int, ratio: float) -> tuple[DataFrame, DataFrame]:
    """Both sides' (_id, _item, _size, _early): an item is early if, counted from the rarest, it is among the first of its
    set that a pair cannot do without, should the set be the smaller one."""
    items = left.unionByName(right)
    seen = items.groupBy("_item").agg(F.count("*").alias("_n"))

    def ranked(side: DataFrame) -> DataFrame:
        rarest = F.sort_array(F.collect_list(F.struct("_n", "_item")))  # a set
        sets = side.join(seen, "_item").groupBy("_id").agg(rarest.alias("_all")).withColumn("_size", F.size("_all"))
        wanted = F.greatest(F.lit(least), F.ceil(F.lit(ratio) * F.col("_size")).cast("int"))
        return sets.select("_id", "_size", F.posexplode("_all").alias("_k", "_one"), wanted.alias("_wanted")).select(
            "_id", "_size", F.col("_one._item").alias("_item"), (F.col("_k") <= F.col("_size") - F.col("_wanted")).alias("_early")
        )

    return ranked(left), ranked(right)


def candidates(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_items: str, right_items: str, least: int, ratio: float) -> DataFrame:
    """Distinct pairs that may share ``least`` items and ``ratio`` of the smaller set (prefix filter).

    A pair shares so many items of the smaller set that one is among its early ones, so these meet all items of the
    larger sets: an item that every row holds is late in nearly every set and joins little.
    """
    of = lambda d, i, c: d.select(F.col(i).alias("_id"), F.explode(F.array_distinct(c)).alias("_item")).where("_item IS NOT NULL")
    a, b = _prefixes(of(left, left_id, left_items), of(right, right_id, right_items), least, ratio)
    a, b = a.withColumnsRenamed({"_id": left_id, "_size": "_a", "_early": "_early_a"}), b.withColumnsRenamed({"_id": right_id, "_size": "_b", "_early": "_early_b"})
    small_left = a.where("_early_a").join(b, "_item").where("_a <= _b")
    small_right = a.join(b.where("_early_b"), "_item").where("_a > _b")
    return small_left.select(left_id, right_id).unionByName(small_right.select(left_id, right_id)).distinct()


def overlapping(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_items: str, right_items: str, least: int = 1, ratio: float = 0.0) -> DataFrame:
    """Pairs whose arrays share at least ``least`` different elements and ``ratio`` of the smaller set (J15's counts, J21).

    Gives both ids, n_shared and ratio, shared elements over the smaller set's size. Ids are unique; null elements and
    arrays are in no pair. Pairs come from a prefix filter and are verified on the sets. Where one common element is
    enough, an element of many rows makes as many pairs as rows hold it on either side: that is the result asked for.
    """
    found = candidates(left, right, left_id, right_id, left_items, right_items, least, ratio)
    of = lambda d, i, c, to: d.select(i, F.array_compact(F.array_distinct(c)).alias(to))
    both = found.join(of(left, left_id, left_items, "_a"), left_id).join(of(right, right_id, right_items, "_b"), right_id)
    shared = F.size(F.array_intersect("_a", "_b")).cast("long")
    counted = both.withColumn("n_shared", shared).withColumn("ratio", F.col("n_shared") / F.greatest(F.lit(1), F.least(F.size("_a"), F.size("_b"))))
    return counted.where((F.col("n_shared") >= least) & (F.col("ratio") >= ratio)).select(left_id, right_id, "n_shared", "ratio")


def token_overlap(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_items: str, right_items: str, least: int = 1, ratio: float = 0.0) -> DataFrame:
    """Overlap of two token sets: shared tokens over the smaller set's size, at least 1 (J15, X29); see ``overlapping``."""
    return overlapping(left, right, left_id, right_id, left_items, right_items, least, ratio)
