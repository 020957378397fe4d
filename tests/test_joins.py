"""Interval, overlap and greedy joins against plain Python, with keys and items that most rows share."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import assign, link, sequence


def day(n):
    return dt.date(1999, 12, 1) + dt.timedelta(n)


def test_day_blocks(spark):
    rng = random.Random(2)
    spans = [(a, a + rng.choice([0, 1, 5, 15, 16, 17, 300, 5000, 100000])) for a in (rng.randint(-800000, 900000) for _ in range(120))] + [(5, 4), (-719162, 2932896)]
    got = spark.createDataFrame(spans, "a long, b long").select("a", "b", link.day_blocks(F.col("a"), F.col("b")).alias("v")).collect()
    for r in got:
        parts = sorted((x["block"] * link.BASE ** x["level"], (x["block"] + 1) * link.BASE ** x["level"]) for x in r["v"])
        if r["a"] > r["b"]:
            assert not parts
            continue
        assert parts[0][0] == r["a"] and parts[-1][1] == r["b"] + 1
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))
        assert len(parts) <= 2 * link.BASE * link.LEVELS


def test_covering_equals_all_pairs(spark):
    rng = random.Random(1)
    key = lambda: "hot" if rng.random() < 0.8 else rng.choice("ab")
    facts = [(key(), k, day(rng.randint(0, 900))) for k in range(300)] + [("hot", 998, None), (None, 999, day(3))]
    spans = [(key(), k, day(a := rng.randint(0, 900)), None if rng.random() < 0.2 else day(a + rng.choice([0, 3, 40, 700]))) for k in range(200)]
    spans += [("a", 900, None, day(3)), ("a", 901, day(30), day(3)), ("a", 902, dt.date(1, 1, 1), None), (None, 903, day(0), None)]
    f, s = spark.createDataFrame(facts, "k string, f int, d date"), spark.createDataFrame(spans, "k string, s int, a date, b date")
    got = {(r["f"], r["s"]) for r in link.covering(f, s, ["k"], "d", "a", "b").collect()}
    want = {(x, y) for k, x, d in facts for j, y, a, b in spans if k is not None and k == j and d and a and a <= d and (b is None or d <= b)}
    assert got == want and len(want) > 1000
    plan = link.covering(f, s, ["k"], "d", "a", "b")._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_covering_of_moments(spark):
    f = spark.sql("SELECT * FROM VALUES (1, 1, timestamp'2020-01-01 10:00'), (1, 2, timestamp'2020-01-01 08:00'), (1, 3, timestamp'2020-01-03 00:00') AS t(k, f, d)")
    s = spark.sql("SELECT * FROM VALUES (1, timestamp'2020-01-01 09:00', timestamp'2020-01-02 23:00') AS t(k, a, b)")
    assert [r["f"] for r in link.covering(f, s, ["k"], "d", "a", "b").collect()] == [1]


def sets(rng, n, hot):
    """Every set has the hot items, most have rare ones besides."""
    return [(k, [*hot, *(f"x{rng.randint(0, 80)}" for _ in range(rng.randint(0, 9)))]) for k in range(n)]


@pytest.mark.parametrize(("least", "ratio"), [(1, 0.0), (3, 0.5), (2, 0.9), (4, 0.0)])
def test_overlapping_equals_all_pairs(spark, least, ratio):
    rng = random.Random(least)
    a, b = sets(rng, 60, ["hot", "warm"]) + [(990, None), (991, []), (992, [None, "hot"])], sets(rng, 50, ["hot"]) + [(993, ["x1", "x1", "x2", "x3"])]
    left, right = spark.createDataFrame(a, "a int, v array<string>"), spark.createDataFrame(b, "b int, w array<string>")
    got = {(r["a"], r["b"]): (r["n_shared"], r["ratio"]) for r in link.overlapping(left, right, "a", "b", "v", "w", least, ratio).collect()}
    want = {}
    for i, v in a:
        for j, w in b:
            x, y = set(v or []) - {None}, set(w or []) - {None}
            n = len(x & y)
            if n >= least and n / max(1, min(len(x), len(y))) >= ratio:
                want[i, j] = (n, n / max(1, min(len(x), len(y))))
    assert got == want


def test_an_item_of_all_rows_joins_nothing(spark):
    rows = [(k, ["hot", f"x{k}", f"y{k // 2}"]) for k in range(400)]
    left, right = spark.createDataFrame(rows, "a int, v array<string>"), spark.createDataFrame(rows, "b int, v array<string>")
    met = link.candidates(left, right, "a", "b", "v", "v", 2, 0.0)
    assert met.count() == 800  # each with itself and its neighbour, of 160,000


def plain_greedy(pairs):
    used, kept = set(), []
    for g, a, b, d in sorted((p for p in pairs if p[3] is not None), key=lambda p: (p[3], p[1], p[2])):
        if (0, g, a) not in used and (1, g, b) not in used:
            used |= {(0, g, a), (1, g, b)}
            kept.append((g, a, b, d))
    return sorted(kept, key=str)


def test_greedy_equals_one_after_the_other(spark):
    rng = random.Random(9)
    pairs = [(rng.choice(["hot"] * 8 + ["b", None]), rng.randint(0, 30), rng.randint(0, 30), rng.choice([None, *range(40)])) for _ in range(700)]
    pairs = list({(g, a, b): (g, a, b, d) for g, a, b, d in pairs}.values())
    df = spark.createDataFrame(pairs, "g string, a int, b int, d int")
    got = sorted((tuple(r) for r in assign.greedy(df, ["g"], "a", "b", "d").collect()), key=str)
    assert got == plain_greedy(pairs) and len(got) > 20
    assert assign.greedy(df.where("false"), ["g"], "a", "b", "d").collect() == []


def test_greedy_along_a_chain(spark):
    """Each pair hangs on the one before it: as many rounds as can be."""
    pairs = [("g", (k + 1) // 2, k // 2, k) for k in range(11)]
    df = spark.createDataFrame(pairs, "g string, a int, b int, d int")
    assert sorted((tuple(r) for r in assign.greedy(df, ["g"], "a", "b", "d").collect()), key=str) == plain_greedy(pairs)


def test_chained(spark):
    df = spark.createDataFrame([("k", v) for v in (1.0, 1.5, 1.5, 3.0, 9.0, None)], "k string, v double")
    got = {r["v"]: r["c"] for r in sequence.chained(df.where("v IS NOT NULL"), ["k"], "v", F.lit(1.5), "c").collect()}
    assert got == {1.0: 1, 1.5: 1, 3.0: 1, 9.0: 2}


def test_interruptions_equal_a_walk(spark):
    rng = random.Random(4)
    rows = [(s, n, rng.choice(["m", "x", "y", None] if n else ["m"]), f"{s}-{n}", rng.choice([5, 20, 40, None]), rng.choice([True, False, None])) for s in range(30) for n in range(rng.randint(1, 25))]
    df = spark.createDataFrame(rows, "s int, n int, who string, id string, w int, a boolean")
    got = {r["id"]: (r["interruption"], r["interruption_start"]) for r in sequence.interruptions(df, "s", "n", "who", "id", "w", "a").collect()}
    want = {}
    for s in range(30):
        said, own, before = 0, {}, None
        for _, _, who, part, w, told in sorted(r for r in rows if r[0] == s):
            if who == "m":
                said += w or 0
                want[part] = (None, None)
            else:
                if before[0] == "m":
                    if who not in own or said >= 30:
                        own[who] = ("kurzintervention" if before[1] else "zwischenfrage", part)
                    said = 0
                want[part] = own.setdefault(who, ("zwischenfrage", part))
            before = (who, told)
    assert got == want


def test_covering_broadcasts_no_blocks(spark):
    rows = lambda *r: "SELECT * FROM VALUES " + ", ".join("(" + ", ".join("null" if x is None else f"date'{x}'" if isinstance(x, dt.date) else str(x) for x in v) + ")" for v in r)
    f = spark.sql(rows((1, day(5)), (1, day(900)), (2, day(5))) + " AS t(k, d)")  # of known, small size
    s = spark.sql(rows((1, day(1), None), (1, day(3), day(9)), (2, day(6), day(7))) + " AS t(k, a, b)")
    met = link.covering(f, s, ["k"], "d", "a", "b")
    assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["k"], r["d"], r["a"]) for r in met.collect()) == [(1, day(5), day(1)), (1, day(5), day(3)), (1, day(900), day(1))]
    # An open end takes wide blocks only.
    blocks = link.day_blocks(link.F.lit(18001), link.F.lit(link.BASE**link.LEVELS - 1))
    assert spark.range(1).select(link.F.size(blocks).alias("n")).first()["n"] < link.BASE * link.LEVELS
