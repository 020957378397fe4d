"""Every catalogue query against its equivalent in DuckDB, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from tessera.plans import records  # noqa: F401 - its queries enter the catalogue
from tessera.plans.catalogue import CATALOGUE
from tessera.plans.oracles import ORACLES
from tessera.session import TABLES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time() else v
    return v


#: One step depends on the one before; these are held against plain Python.
NO_SQL = {"greedy_pairs", "best_assignment"}


def test_every_query_has_an_equivalent():
    assert set(CATALOGUE) - NO_SQL == set(ORACLES)


def test_greedy_pairs(spark, sf):
    pairs = CATALOGUE["tolerance_pairs"](spark, sf).collect()
    taken, want = set(), set()
    for r in sorted(pairs, key=lambda r: (r["difference"], r["a_key"], r["b_key"])):
        a, b = ("a", r["s_nationkey"], r["a_key"]), ("b", r["s_nationkey"], r["b_key"])
        if a not in taken and b not in taken:
            taken |= {a, b}
            want.add((r["a_key"], r["b_key"]))
    assert {(r["a_key"], r["b_key"]) for r in CATALOGUE["greedy_pairs"](spark, sf).collect()} == want


def test_interruption_machine(spark, sf):
    got = {r["event_id"]: (r["interruption"], r["interruption_start"]) for r in CATALOGUE["interruption_machine"](spark, sf).collect()}
    days = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").orderBy("ts").collect():
        days.setdefault((r["user_id"], r["ts"].date()), []).append(r)
    want = {}
    for rows in days.values():
        main, said, own, before = rows[0]["event_type"], 0, {}, None
        for r in rows:
            kind = r["event_type"]
            if kind == main:
                said += int(r["value"])
                want[r["event_id"]] = (None, None)
            else:
                if before is not None and before["event_type"] == main:
                    if kind not in own or said >= 30:
                        own[kind] = ("kurzintervention" if before["event_type"] == "signup" else "zwischenfrage", r["event_id"])
                    said = 0
                want[r["event_id"]] = own.setdefault(kind, ("zwischenfrage", r["event_id"]))
            before = r
    assert got == {k: (x, None if y is None else str(y)) for k, (x, y) in want.items()}


def test_best_assignment(spark, sf):
    got = CATALOGUE["best_assignment"](spark, sf).collect()
    asked = [(r["conv_id"], r["asked"]) for r in got]
    assert got and len(set(asked)) == len(asked) and len({(r["conv_id"], r["answered"]) for r in got}) == len(got)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, duck, name):
    got = CATALOGUE[name](spark, sf)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    at = {c: k for k, c in enumerate(want.columns)}
    a = sorted((tuple(norm(r[c]) for c in columns) for r in got.collect()), key=repr)
    b = sorted((tuple(norm(r[at[c]]) for c in columns) for r in want.fetchall()), key=repr)
    assert a == b


def test_votes_of_parts_with_long_keys(spark, sf, duck, tmp_path):
    """Part keys of seven digits and more, as large tables have them."""
    for t in ("orders", "supplier", "customer"):
        os.symlink(f"{sf}/{t}.parquet", tmp_path / f"{t}.parquet")
    shift = "CASE WHEN {0} % 3 = 0 THEN {0} ELSE {0} + 999900 + 1000000 * ({0} % 70) END"
    for t, key in (("lineitem", "l_partkey"), ("part", "p_partkey")):
        duck.sql(f"COPY (SELECT * REPLACE ({shift.format(key)} AS {key}) FROM {t}) TO '{tmp_path}/{t}.parquet'")
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    want = sorted(con.sql(ORACLES["step_votes_to_items"]).fetchall(), key=str)
    got = CATALOGUE["step_votes_to_items"](spark, str(tmp_path)).select("vote_id", "sitting_id", "agenda_item_id").collect()
    assert sorted(map(tuple, got), key=str) == want
    assert any(x is not None and int(v.split("-")[2]) > 999_999 and v.split("-")[1] == "2" for v, _, x in want)


def test_characters_are_dealt_by_their_number(spark, sf, monkeypatch):
    from tessera.operators import rounds

    monkeypatch.setattr(rounds, "ROWS", 1000)
    found = CATALOGUE["lines_of_characters"](spark, sf)
    n = spark.read.parquet(f"{sf}/conversations.parquet").selectExpr("sum(length(text))").first()[0]
    assert n > 8000 and found.rdd.getNumPartitions() == -(-n // 1000)
