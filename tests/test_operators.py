import datetime
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import assign, checks, dedup, intervals, link, sequence, upsert

D = datetime.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_takes_the_newest_copy(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w")], "id string, at int, path string")
    assert rows(dedup.latest(df, ["id"], "at", "path")) == [("a", 2, "z"), ("b", None, "w")]


def test_first_of_sources(spark):
    a, b = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a")], [(1, "b"), (2, "c")]))
    assert rows(dedup.first_of_sources([a, b], ["k"])) == [(1, "a"), (2, "c")]


def test_suffixed(spark):
    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, "p"), (4, "p")], "n int, base string")
    assert [r["id"] for r in dedup.suffixed(df, "base", [F.col("n")], "id").orderBy("n").collect()] == ["p", "q", "p-2", "p-3"]


def test_majority_breaks_ties(spark):
    df = spark.createDataFrame([("g", v) for v in ("no", "yes", "yes", "no", "absent")], "k string, v string")
    assert rows(A.majority(df, ["k"], "v", "m", "c")) == [("g", "no", "absent:1,no:2,yes:2")]


def test_completeness(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (3, 1), (3, 3)], "n int, d int")
    assert [r[0] for r in df.select(A.completeness(F.col("n"), F.col("d"))).collect()] == ["unanswered", "failed", "partial", "complete"]


def test_asof_both_ways(spark):
    left = spark.createDataFrame([("u", 5, 1), ("u", 1, 2), ("v", 9, 3)], "k string, at int, id int")
    right = spark.createDataFrame([("u", 3, "a"), ("u", 5, "b"), ("u", 8, "c"), ("w", 1, "d")], "k string, at int, r string")
    back = {r["id"]: r["r"] for r in link.asof(left, right, ["k"], "at", ["r"]).collect()}
    on = {r["id"]: r["r"] for r in link.asof(left, right, ["k"], "at", ["r"], forward=True).collect()}
    assert back == {1: "b", 2: None, 3: None} and on == {1: "b", 2: "a", 3: None}


def test_asof_in_buckets_is_asof(spark):
    import random

    rng = random.Random(1)
    left = spark.createDataFrame([(rng.choice(["u", "v", None]), rng.randint(0, 99), k) for k in range(60)], "k string, at int, id int")
    right = spark.createDataFrame([(k, t, 1000 + n) for n, (k, t) in enumerate({(rng.choice(["u", "w"]), rng.randint(0, 99)) for _ in range(25)})], "k string, at int, r int")
    bucket = F.floor(F.col("at") / 10)
    want = rows(link.asof(left, right, ["k"], "at", ["r"]))
    assert rows(link.asof_in_buckets(left, right, ["k"], "at", ["r"], bucket)) == want
    strict = {r["id"]: r["r"] for r in link.asof(left, right, ["k"], "at", ["r"], strict=True).collect()}
    plain = {(r["k"], r["at"]): r["r"] for r in right.collect()}
    assert all(v is None or v != plain.get((k, t)) for k, t, i in left.collect() for v in [strict[i]])


def test_nearest_takes_the_smaller_id_of_two(spark):
    left = spark.createDataFrame([("u", 5, 1)], "k string, at int, id int")
    right = spark.createDataFrame([("u", 3, 9), ("u", 7, 4), ("u", 8, 1)], "k string, at int, r int")
    assert rows(link.nearest(left, right, ["k"], "at", "r", lambda a, b: F.abs(a - b)).select("id", "r", "distance")) == [(1, 4, 2)]


def test_positional_only_where_counts_agree(spark):
    a = spark.createDataFrame([("d", 1), ("d", 2), ("e", 1)], "day string, n int")
    b = spark.createDataFrame([("d", "x"), ("d", "y"), ("e", "z"), ("e", "w")], "day string, p string")
    assert rows(link.positional(a, b, ["day"], ["n"], ["p"], ["n"], ["p"])) == [("d", 1, 1, "x"), ("d", 2, 2, "y")]


def test_band_join_finds_all_within(spark):
    a = spark.createDataFrame([("k", float(x)) for x in range(0, 50, 7)], "k string, a double")
    b = spark.createDataFrame([("k", float(x)) for x in range(0, 50, 3)], "k string, b double")
    got = {(r["a"], r["b"]) for r in link.within_tolerance(a, b, ["k"], "a", "b", 4.0).collect()}
    assert got == {(float(x), float(y)) for x in range(0, 50, 7) for y in range(0, 50, 3) if abs(x - y) <= 4}


def test_cascade_first_nonempty_variant_decides(spark):
    people = spark.createDataFrame([(1, "a", "x", 1970), (2, "a", "x", 1980), (3, "a", "y", 1990), (4, "b", "z", 1960)], "id int, l string, f string, y int")
    probes = spark.createDataFrame([(10, "a", "x", 1970), (11, "a", "x", None), (12, "a", "q", None), (13, "b", "q", None), (14, "a", "x", 1999), (15, "c", "c", None)], "p int, l string, f string, y int")
    steps = [(F.concat_ws("|", "l", "f"), people, F.concat_ws("|", "l", "f")), (F.col("l"), people, F.col("l"))]
    got = {r["p"]: (r["matched_id"], r["step"]) for r in link.cascade(probes, "p", "y", steps, "id", "y").collect()}
    assert got == {10: (1, 1), 11: (None, 1), 12: (None, 2), 13: (4, 2), 14: (None, None), 15: (None, None)}


def test_precedence_and_exclusion(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "d int, v string")
    b = spark.createDataFrame([(1, "z"), (2, "z")], "d int, v string")
    assert rows(link.by_precedence([("first", a), ("second", b)], "d", "v")) == [(1, "first", 2, None), (2, "second", 1, "z")]
    assert rows(link.without_shared(b, "v", "d", 1)) == []


def test_assignments(spark):
    pairs = spark.createDataFrame([("g", a, b, s) for a, b, s in ((1, 1, 0.1), (1, 2, 0.9), (2, 1, 0.8), (2, 2, 0.2))], "g string, a int, b int, s double")
    assert rows(assign.best_assignment(pairs, ["g"], "a", "b", "s")) == [("g", 1, 2), ("g", 2, 1)]
    close = spark.createDataFrame([("g", a, b, s) for a, b, s in ((1, 1, 0.5), (1, 2, 0.55), (2, 1, 0.55), (2, 2, 0.5))], "g string, a int, b int, s double")
    assert rows(assign.best_assignment(close, ["g"], "a", "b", "s")) == [("g", 1, 1), ("g", 2, 2)]
    dist = spark.createDataFrame([("g", 1, 1, 5), ("g", 1, 2, 1), ("g", 2, 2, 2), ("g", 2, 1, 9)], "g string, a int, b int, d int")
    assert rows(assign.greedy(dist, ["g"], "a", "b", "d")) == [("g", 1, 2, 1), ("g", 2, 1, 9)]


def test_assignments_of_unequal_sides(spark):
    schema = "g string, a int, b int, s double"
    wide = spark.createDataFrame([("g", 1, 1, 0.0), ("g", 1, 2, 1.0)], schema)
    assert rows(assign.best_assignment(wide, ["g"], "a", "b", "s")) == [("g", 1, 2)]
    tall = spark.createDataFrame([("g", a, b, s) for a, b, s in ((1, 1, 0.0), (1, 2, 0.0), (2, 1, 0.1), (2, 2, 0.9), (3, 1, 0.8), (3, 2, 0.3))], schema)
    assert rows(assign.best_assignment(tall, ["g"], "a", "b", "s")) == [("g", 2, 2), ("g", 3, 1)]
    close = spark.createDataFrame([("g", 1, 1, 0.5), ("g", 1, 2, 0.6)], schema)
    assert rows(assign.best_assignment(close, ["g"], "a", "b", "s")) == [("g", 1, 1)]


def test_sequences(spark):
    df = spark.createDataFrame([("u", k, v) for k, v in enumerate("aabba")], "k string, n int, v string")
    assert [r["part"] for r in sequence.islands(df, ["k"], ["n"], "v").orderBy("n").collect()] == [1, 1, 2, 2, 3]
    assert [r["b"] for r in sequence.count_before(df, ["k"], ["n"], F.col("v") == "a", "b").orderBy("n").collect()] == [0, 1, 2, 2, 2]
    assert [r["c"] for r in sequence.carried(df, ["k"], ["n"], F.when(F.col("v") == "b", F.col("n")), "c").orderBy("n").collect()] == [None, None, 2, 3, 3]
    assert [r["block"] for r in sequence.blocks(df, ["k"], ["n"], F.col("v") == "b").orderBy("n").collect()] == [1, 2, 2]
    assert sequence.blocks(df, ["k"], ["n"], F.col("n") == 3).collect() == []


def test_interruptions(spark):
    t = [
        ("r", 1, "main", "s1", 40, False),
        ("r", 2, "guest", "s2", 5, False),
        ("r", 3, "main", "s3", 2, False),
        ("r", 4, "guest", "s4", 5, False),
        ("r", 5, "other", "s5", 5, False),
        ("r", 6, "main", "s6", 50, True),
        ("r", 7, "guest", "s7", 5, False),
    ]
    df = spark.createDataFrame(t, "r string, n int, who string, id string, w int, a boolean")
    got = [(x["interruption"], x["interruption_start"]) for x in sequence.interruptions(df, "r", "n", "who", "id", "w", "a").orderBy("n").collect()]
    assert got == [(None, None), ("zwischenfrage", "s2"), (None, None), ("zwischenfrage", "s2"), ("zwischenfrage", "s5"), (None, None), ("kurzintervention", "s7")]


def test_intervals(spark):
    df = spark.createDataFrame([("p", D(2020, 1, 1), D(2021, 1, 1)), ("p", D(2019, 1, 1), None), ("q", D(2020, 1, 1), D(2020, 2, 1))], "k string, f date, t date")
    assert rows(intervals.combine(df, ["k"], "f", "t")) == [("p", D(2019, 1, 1), None), ("q", D(2020, 1, 1), D(2020, 2, 1))]
    held = spark.createDataFrame([("o", "a", D(2020, 1, 1), None), ("o", "b", D(2020, 6, 1), D(2020, 7, 1))], "o string, who string, f date, t date")
    later = spark.createDataFrame([("o", "b", D(2020, 5, 2)), ("o", "c", D(2020, 9, 1)), ("o", "a", D(2020, 3, 1))], "o string, who string, f date")
    closed = {r["who"]: (r["t"], r["successor"]) for r in intervals.close_by_successor(held, later, ["o"], "who", "f", "t").collect()}
    assert closed == {"a": (D(2020, 5, 1), "b"), "b": (D(2020, 7, 1), None)}


def test_successors_against_all_pairs(spark):
    rng = random.Random(7)
    day = lambda: rng.choice([None, *(D(2020, 1, k) for k in range(1, 9))])
    some = lambda n: [(rng.choice(["o", "p", None]), rng.choice(["a", "b", "c", None]), day()) for _ in range(n)]
    held = [(*x, k, D(2021, 1, 1) if k % 5 == 0 else None) for k, x in enumerate(some(120))]
    later = some(25)
    want = {}
    for o, who, f, k, t in held:
        met = [(g, w) for p, w, g in later if None not in (o, who, f, p, w, g) and (p, g > f, w != who) == (o, True, True)]
        g, w = min(met) if met and t is None else (None, None)
        want[k] = (t or (g - datetime.timedelta(1) if g else None), w)
    h = spark.createDataFrame(held, "o string, who string, f date, k int, t date")
    got = intervals.close_by_successor(h, spark.createDataFrame(later, "o string, who string, f date"), ["o"], "who", "f", "t")
    assert {r["k"]: (r["t"], r["successor"]) for r in got.collect()} == want and got.columns == ["o", "who", "f", "k", "t", "successor"]
    assert intervals.close_by_successor(h.limit(0), h.select("o", "who", "f"), ["o"], "who", "f", "t").count() == 0


@pytest.mark.parametrize("on, want", [("2020-02-15", {"1", "2", "4"}), ("2020-04-15", {"1", "3"}), ("2019-01-01", set())])
def test_held_on(spark, on, want):
    """A sighting counts on until the same person, or the next holder of a single office, contradicts it."""
    r = [
        ("1", "p", "clerk", "register", D(2020, 1, 1), None),
        ("2", "q", "chief", "seen", D(2020, 1, 1), D(2020, 2, 1)),
        ("3", "s", "chief", "seen", D(2020, 4, 1), D(2020, 5, 1)),
        ("4", "s", "aide", "seen", D(2020, 1, 1), D(2020, 2, 1)),
    ]
    df = spark.createDataFrame(r, "id string, who string, office string, src string, f date, t date")
    got = intervals.held_on(df, F.lit(on).cast("date"), "id", "who", ["office"], F.col("office") == "chief", F.col("src") == "seen", "f", "t")
    assert {x["id"] for x in got.collect()} == want


def test_upsert_touches_given_columns_only(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "id int, v string, other string")
    c = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, None, 1)], "id int, v string, seq int")
    once = upsert.upsert(t, c, ["id"], [F.col("seq").desc()])
    assert rows(once) == [(1, "a", "keep"), (2, "y", "keep"), (3, None, None)]
    assert rows(upsert.upsert(once, c, ["id"], [F.col("seq").desc()])) == rows(once)
    keys = spark.createDataFrame([(1,), (9,)], "id int")
    assert rows(upsert.upsert(t, keys, ["id"])) == [(1, "a", "keep"), (2, "b", "keep"), (9, None, None)]
    assert rows(upsert.upsert(t, c, ["id"])) == rows(upsert.upsert(t, c.orderBy(F.rand(1)).repartition(3), ["id"]))


def test_stale_rows_and_first_times(spark):
    t = spark.createDataFrame([(1, "s"), (2, "s"), (3, "r")], "id int, k string")
    assert rows(upsert.drop_stale(t, spark.createDataFrame([(1,)], "id int"), ["id"], F.col("k") == "s")) == [(1, "s"), (3, "r")]
    a = spark.createDataFrame([("x", "p", "monday")], "alias string, person string, at string")
    b = spark.createDataFrame([("x", "q", "friday"), ("y", "r", "friday")], "alias string, person string, at string")
    assert rows(upsert.insert_or_update(a, b, ["alias"], ["at"])) == [("x", "q", "monday"), ("y", "r", "friday")]


def test_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    upsert.write_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


def test_not_in_has_sql_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    v = lambda x: spark.createDataFrame(x, "y int")
    assert rows(checks.not_in(df, "x", v([(1,)]), "y")) == [(2,)]
    assert rows(checks.not_in(df, "x", v([(1,), (None,)]), "y")) == []
    assert rows(checks.not_in(df, "x", v([]), "y")) == [(1,), (2,), (None,)]


def test_snapshots(spark):
    s = lambda x: spark.createDataFrame(x, "k string, n long")
    diff = checks.snapshot_diff(s([("a", 100), ("b", 100), ("c", 5), ("d", 9)]), s([("a", 96), ("b", 94), ("c", 0), ("e", 1)]), "k", "n")
    assert {r["k"]: r["failed"] for r in diff.collect()} == {"a": False, "b": True, "c": True, "d": True, "e": False}


def test_large_tables_are_dealt_into_more_partitions(spark):
    from tessera.operators.rounds import ROWS, dealt

    df = spark.range(10)
    assert dealt(df, 10, "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(df, 100 * ROWS, "id").rdd.getNumPartitions() == 100
    assert dealt(df, 10, "id").count() == 10


def test_reconcile_meets_each_side_once(spark, sf):
    from tessera.plans.catalogue import CATALOGUE

    plan = CATALOGUE["reconcile_two_sources"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("RepartitionByExpression") == 2


def test_greedy_deals_its_pairs(spark, monkeypatch):
    from tessera.operators import assign, link, rounds

    asked = []
    monkeypatch.setattr(assign, "dealt", lambda df, n, *keys: asked.append(n) or rounds.dealt(df, n, *keys))
    pairs = [("k", a, b, float((a * 7 + b * 5) % 11)) for a in range(12) for b in range(12)] * 2
    got = {(r["a"], r["b"]) for r in assign.greedy(spark.createDataFrame(pairs, "k string, a int, b int, d double"), ["k"], "a", "b", "d").collect()}
    left, right, want = set(), set(), set()
    for _, a, b, _ in sorted(pairs, key=lambda p: (p[3], p[1], p[2])):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            want.add((a, b))
    assert got == want and asked[0] == len(pairs)
    # Candidate pairs are made by more than one task, however small the tables are.
    s = spark.sql("SELECT 1 AS k, id AS a, CAST(id AS double) AS x FROM range(9)")
    near = link.within_tolerance(s, s.withColumnsRenamed({"a": "b", "x": "y"}), ["k"], "x", "y", 2.0)
    assert near.count() == 39 and "RepartitionByExpression" in near._jdf.queryExecution().optimizedPlan().toString()
