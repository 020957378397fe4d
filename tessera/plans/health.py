"""Health of a store: counts of tables and of sixteen problems, snapshots, and what a change means."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import checks
from tessera.plans import queries

Tables = Mapping[str, DataFrame]
Problem = Callable[[Tables], DataFrame]


def _n(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _rows(table: str, condition: str) -> Problem:
    return lambda t: _n(t[table].where(condition))


def _distinct(table: str, column: str, condition: str) -> Problem:
    return lambda t: t[table].where(condition).agg(F.count_distinct(column).alias("n"))


def _gaps(preliminary: bool) -> Problem:
    def count(t: Tables) -> DataFrame:
        causes = queries.protocol_gaps(t).select(F.explode("beratungen.cause").alias("cause"))
        return _n(causes.where((F.col("cause") == "preliminary") == F.lit(preliminary)))

    return count


def _check(kind: str) -> Problem:
    return lambda t: _n(queries.decision_check(t).where(F.col("kind") == kind))


#: Problem, how to count it, and the rise that fails a run (None: it is only reported).
PROBLEMS: dict[str, tuple[Problem, int | None]] = {
    "protocol_gaps": (_gaps(False), 10),
    "protocol_gaps_preliminary": (_gaps(True), None),
    "decision_results_disputed": (_check("result"), 5),
    "decisions_missing": (_check("missing"), 10),
    "preliminary_sittings": (_rows("sitting", "preliminary"), None),
    "stale_roles": (lambda t: _n(queries.stale_roles(t)), None),
    "unmatched_votes": (_rows("individual_vote", "person_id IS NULL"), 100),
    "unlinked_roll_calls": (_rows("roll_call_vote", "vorgang_id IS NULL"), 5),
    "placeholder_speakers": (_rows("person", "startswith(id, 'pdf-')"), None),
    "vorlagen_without_vorgang": (_rows("agenda_item_vorlage", "vorgang_id IS NULL"), 150),
    "unresolved_authors": (_distinct("drucksache_author", "dip_person_id", "person_id IS NULL"), None),
    "askers_without_person": (_distinct("question_activity", "dip_person_id", "activity_type IN ('Frage', 'Zusatzfrage') AND person_id IS NULL"), 10),
    "questions_without_vorgang": (_rows("question_text", "part = 'frage' AND vorgang_id IS NULL"), 10),
    "unmatched_elected": (_rows("election_candidacy", "person_id IS NULL"), 3),
    "unmatched_successors": (_rows("mandate_successor", "person_id IS NULL"), 3),
    "hib_reports_without_committee": (_rows("hib_item", "kind IN ('Ausschuss', 'Anhörung') AND committee IS NULL"), 10),
}


def problems(t: Tables, names: list[str] | None = None) -> DataFrame:
    """(problem, n) of each problem; those whose tables are missing are left out by naming the others."""
    each = [PROBLEMS[k][0](t).select(F.lit(k).alias("problem"), "n") for k in names or PROBLEMS]
    return reduce(DataFrame.unionByName, each)


def snapshot(t: Tables) -> DataFrame:
    """(kind, name, n): rows of every table and counts of every problem, to be appended under the day of the run."""
    counts = checks.table_counts(t).select(F.lit("table").alias("kind"), F.col("table_name").alias("name"), F.col("n_rows").alias("n"))
    return counts.unionByName(problems(t).select(F.lit("problem").alias("kind"), F.col("problem").alias("name"), "n"))


@dataclass(frozen=True)
class Report:
    tables: DataFrame
    problems: DataFrame

    def failures(self) -> list[str]:
        """Names of what fails; bounded by the numbers of tables and problems."""
        t = [r["name"] for r in self.tables.where("failed").select("name").collect()]
        return t + [r["problem"] for r in self.problems.where("failed").select("problem").collect()]


def compare(before: DataFrame, now: DataFrame, most_loss: float = 0.05) -> Report:
    """Two snapshots: tables that are gone, empty or smaller by over ``most_loss``, and problems that rose too far."""
    of = lambda d, kind: d.where(F.col("kind") == kind).select("name", "n")
    problem = lambda d: of(d, "problem").withColumnRenamed("name", "problem")
    limits = {k: v for k, (_, v) in PROBLEMS.items()}
    # A problem that is counted for the first time has nothing to rise from.
    known = problem(now).join(problem(before).select("problem"), "problem", "left_semi")
    return Report(checks.snapshot_diff(of(before, "table"), of(now, "table"), "name", "n", most_loss), checks.problem_rises(problem(before), known, limits))


def latest_before(snapshots: DataFrame, day: str, column: str = "day") -> DataFrame:
    """The newest snapshot of an earlier day."""
    earlier = snapshots.where(F.col(column) < F.lit(day).cast("date"))
    newest = earlier.agg(F.max(column).alias(column))
    return earlier.join(F.broadcast(newest), column, "left_semi")
