"""The build: which steps make which tables, in which order, out of which others.

A step names the tables it needs and those it makes. Steps run in an order in which each
finds what earlier ones made; every step's images are written to the store together, so
a failed one leaves the tables as they were and the next run starts there again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.upsert import upsert
from tessera.plans import steps
from tessera.plans.schemas import TABLES, conform
from tessera.plans.store import Store

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """``make(raw, tables)`` gives new images of ``makes``; ``needs`` are raw inputs without which it is passed over."""

    name: str
    makes: tuple[str, ...]
    make: Callable[[Tables, Tables], dict[str, DataFrame]]
    needs: tuple[str, ...] = ()


def provenance(df: DataFrame, document: Column) -> DataFrame:
    """source_url and retrieved_at as they are, and the document to cite."""
    return df.withColumn("source_document_id", document)


def _upserted(t: Tables, name: str, df: DataFrame) -> DataFrame:
    """The table with the columns that ``df`` has merged in, so that what other sources gave stays."""
    known = [c for c in TABLES[name].schema.names if c in df.columns]
    return upsert(t[name], df.select(*known), list(TABLES[name].key))


def _members(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    return {n: _upserted(t, n, raw[f"members_{n}"]) for n in ("person", "mandate", "membership")}


def _reports(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    """A report's tables replace its earlier ones whole; unknown speakers become persons."""
    done = raw["report_sitting"].select(F.col("id").alias("sitting_id")).distinct()
    items = t["agenda_item"].join(done, "sitting_id", "left_semi").select(F.col("id").alias("agenda_item_id"))
    spoken = t["speech"].join(done, "sitting_id", "left_semi").select(F.col("id").alias("speech_id"))
    out = {"sitting": _upserted(t, "sitting", raw["report_sitting"])}
    scope = {"agenda_item": done, "speech": done, "agenda_sub_item": items, "agenda_item_paragraph": items, "speech_paragraph": spoken, "interjection": spoken}
    for name, keys in scope.items():
        out[name] = t[name].join(keys, keys.columns[0], "left_anti").unionByName(conform(raw[f"report_{name}"], name), allowMissingColumns=True)
    new = raw["report_person"].join(t["person"].select("id"), "id", "left_anti").withColumn("is_mdb", F.lit(False))
    return out | {"person": t["person"].unionByName(conform(new, "person"))}


def _votes(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    v = raw["vote_rows"].withColumn("id", F.concat_ws("/", "vote_id", "row"))
    period = raw["vote_rows"].agg(F.max("wahlperiode")).first()[0] or 0
    matched = steps.match_persons(v, "id", "last_name", "first_name", None, t["person"], t["mandate"], period, voters=True)
    rows = steps.with_person(v, matched, "id")
    gone = raw["vote_rows"].select("vote_id").distinct()
    kept = t["individual_vote"].join(gone, "vote_id", "left_anti")
    return {"roll_call_vote": _upserted(t, "roll_call_vote", raw["vote_list"]), "individual_vote": kept.unionByName(conform(rows, "individual_vote"))}


def _register(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    made = raw["register_authors"]
    docs = steps.counted_authors(steps.documents(raw["register_documents"]), made)
    positions = steps.procedure_steps(raw["register_positions"])
    return {
        "drucksache": _upserted(t, "drucksache", docs),
        "drucksache_author": conform(steps.by_external_id(made, "dip_person_id", t["person"]), "drucksache_author"),
        "vorgang": _upserted(t, "vorgang", raw["register_procedures"]),
        "vorgang_drucksache": _upserted(t, "vorgang_drucksache", raw["register_links"]),
        "vorgang_position": _upserted(t, "vorgang_position", positions),
        "vorgang_referral": conform(steps.referrals(raw["register_positions"]), "vorgang_referral"),
        "question_activity": conform(steps.by_external_id(steps.question_activities(raw["register_activities"]), "dip_person_id", t["person"]), "question_activity"),
    }


def _vote_links(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    return {"roll_call_vote": steps.link_votes_to_steps(t["roll_call_vote"], raw["register_positions"], t["vorgang"])}


def _decisions(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    made = conform(steps.decisions_in_sub_items(raw["decisions"].withColumn("sub_item_id", F.lit(None).cast("string")), t["agenda_sub_item"]), "decision")
    groups = raw["decisions"].select(F.col("id").alias("decision_id"), F.explode("fractions").alias("fraction", "position"))
    return {"decision": made, "decision_fraction": conform(groups, "decision_fraction")}


def _items(_: Tables, t: Tables) -> dict[str, DataFrame]:
    source = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), "source_url", "source_document_id", "retrieved_at")
    rows = conform(steps.item_documents(t).join(source, "agenda_item_id"), "agenda_item_vorlage")
    now = dict(t) | {"agenda_item_vorlage": rows}
    links = steps.decision_procedures(now)
    return {"agenda_item_vorlage": rows, "decision_vorgang": links, "decision": steps.decided_columns(now, links), "roll_call_vote": steps.votes_to_items(now)}


def _questions(_: Tables, t: Tables) -> dict[str, DataFrame]:
    return {"question_parse": steps.question_status(t)}


def _government(raw: Tables, t: Tables, since: str = "2025-05-06") -> dict[str, DataFrame]:
    e = raw["office_statements"].unionByName(steps.membership_offices(t, since), allowMissingColumns=True).unionByName(steps.spoken_offices(t, since), allowMissingColumns=True)
    return {"government_role": steps.government_roles(e)}


def _elections(raw: Tables, t: Tables) -> dict[str, DataFrame]:
    period = t["mandate"].agg(F.max("wahlperiode")).first()[0] or 0
    c = raw["elected"]
    matched = steps.match_elected(c, t["person"], t["mandate"], period)
    made = steps.with_person(c, matched, "position").withColumn("id", F.concat_ws("/", "election", "position"))
    return {
        "election_candidacy": conform(made, "election_candidacy"),
        "constituency": conform(raw["constituencies"].withColumn("id", F.concat_ws("/", "election", "number")), "constituency"),
        "constituency_result": conform(raw["results"].withColumn("id", F.concat_ws("/", "election", "constituency_number", "group_order", "vote")), "constituency_result"),
    }


def _groups(_: Tables, t: Tables) -> dict[str, DataFrame]:
    return {"person": steps.person_groups(t), "speech": steps.speech_groups(t), "drucksache": steps.document_groups(t["drucksache"]), "party_fraction": steps.party_map(t)}


def _parts(_: Tables, t: Tables) -> dict[str, DataFrame]:
    items = steps.item_kinds(t)
    return {"agenda_item": items, "speech": steps.speech_parts(dict(t) | {"agenda_item": items})}


#: In the order of the build; later steps read what earlier ones made.
STEPS: tuple[Step, ...] = (
    Step("members", ("person", "mandate", "membership"), _members, ("members_person", "members_mandate", "members_membership")),
    Step("reports", ("sitting", "agenda_item", "agenda_sub_item", "agenda_item_paragraph", "speech", "speech_paragraph", "interjection", "person"), _reports,
         ("report_sitting", "report_agenda_item", "report_agenda_sub_item", "report_agenda_item_paragraph", "report_speech", "report_speech_paragraph", "report_interjection", "report_person")),
    Step("votes", ("roll_call_vote", "individual_vote"), _votes, ("vote_rows", "vote_list")),
    Step("register", ("drucksache", "drucksache_author", "vorgang", "vorgang_drucksache", "vorgang_position", "vorgang_referral", "question_activity"), _register,
         ("register_documents", "register_authors", "register_procedures", "register_links", "register_positions", "register_activities")),
    Step("vote_links", ("roll_call_vote",), _vote_links, ("register_positions",)),
    Step("decisions", ("decision", "decision_fraction"), _decisions, ("decisions",)),
    Step("item_documents", ("agenda_item_vorlage", "decision_vorgang", "decision", "roll_call_vote"), _items),
    Step("question_status", ("question_parse",), _questions),
    Step("elections", ("election_candidacy", "constituency", "constituency_result"), _elections, ("elected", "constituencies", "results")),
    Step("government", ("government_role",), _government, ("office_statements",)),
    Step("groups", ("person", "speech", "drucksache", "party_fraction"), _groups),
    Step("speech_parts", ("agenda_item", "speech"), _parts),
)


def build(store: Store, raw: Tables, names: Sequence[str] | None = None) -> list[str]:
    """Runs the steps whose raw inputs are there (or those named), writes what each makes, and tells which ran."""
    ran = []
    for step in STEPS:
        if (names is not None and step.name not in names) or any(n not in raw for n in step.needs):
            continue
        made = step.make(raw, store.tables())
        if set(made) != set(step.makes):
            raise ValueError(f"{step.name} makes {sorted(made)}, not {sorted(step.makes)}")
        store.write(made)
        ran.append(step.name)
    return ran
