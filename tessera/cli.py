"""Command line: ``query``, ``health`` and ``export`` over a store.

    python -m tessera.cli STORE query votes --person Muster --from 2025-01-01 --to 2025-12-31 [--json]
    python -m tessera.cli STORE health [--snapshots DIR --day 2025-07-01]
    python -m tessera.cli STORE export TARGET
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import export, health, queries
from tessera.plans.store import Store

DATED: dict[str, Callable] = {"speeches": queries.speeches, "votes": queries.votes, "drucksachen": queries.documents}
PLAIN: dict[str, Callable] = {
    "photos": queries.photos,
    "photos-missing": queries.photos_missing,
    "stale-roles": queries.stale_roles,
    "protocol-gaps": queries.protocol_gaps,
    "decision-check": queries.decision_check,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("store")
    sub = p.add_subparsers(dest="command", required=True)
    q = sub.add_parser("query").add_subparsers(dest="name", required=True)
    day = datetime.date.fromisoformat
    for name in (*DATED, "corpus", *PLAIN, "government", "decisions"):
        c = q.add_parser(name)
        c.add_argument("--json", action="store_true")
        if name in DATED or name == "corpus":
            c.add_argument("--from", dest="start", type=day, required=True)
            c.add_argument("--to", dest="end", type=day, required=True)
        if name in DATED:
            c.add_argument("--person", required=True)
        if name == "government":
            c.add_argument("--on", type=day)
        if name == "decisions":
            c.add_argument("sitting")
    h = sub.add_parser("health")
    h.add_argument("--snapshots")
    h.add_argument("--day", type=day, default=datetime.date.today())
    sub.add_parser("export").add_argument("target")
    return p


def plan(store: Store, a: argparse.Namespace) -> DataFrame:
    t = store.tables()
    if a.name in DATED:
        return DATED[a.name](t, queries.resolve_person(t, a.person), a.start, a.end)
    if a.name == "corpus":
        return queries.corpus(t, a.start, a.end)
    if a.name == "government":
        return queries.government(t, a.on)
    if a.name == "decisions":
        return queries.decisions(t, a.sitting)
    return PLAIN[a.name](t)


def printed(df: DataFrame, as_json: bool):
    """One line a row (K12), a partition at a time."""
    for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")).toLocalIterator():
        yield r["row"] if as_json else " | ".join("" if v is None else str(v) for v in json.loads(r["row"]).values())


def check(store: Store, a: argparse.Namespace) -> int:
    now = health.snapshot(store.tables()).persist()
    for r in now.orderBy("kind", "name").toLocalIterator():
        print(f"{r['kind']} {r['name']}: {r['n']:,}")
    failures: list[str] = []
    if a.snapshots:
        spark = store.spark
        try:
            before = health.latest_before(spark.read.parquet(a.snapshots), str(a.day)).drop("day")
        except Exception as e:  # noqa: BLE001 - the first run has nothing to read
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            failures = health.compare(before, now).failures()
        now.withColumn("day", F.lit(a.day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(a.snapshots)
    for f in failures:
        print(f"FAIL {f}")
    return int(bool(failures))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if spark is None:
        from tessera.session import get_session

        spark = get_session()
    store = Store(spark, a.store)
    if a.command == "health":
        return check(store, a)
    if a.command == "export":
        for w in export.write_export(store.tables(), a.target, "Parliamentary records", datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")):
            print(f"{w['name']}: {export.thousands(w['rows'])} rows, {export.size(w['bytes'])}")
        return 0
    try:
        for text in printed(plan(store, a), a.json):
            print(text)
    except queries.Unclear as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
