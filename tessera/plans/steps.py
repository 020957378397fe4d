"""Pipeline steps: raw records and tables in, tables out. No step writes; ``store`` does that.

Steps name their inputs; ``pipeline`` orders them. Derived columns are projections that
replace a column, so running a step twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.groups import department_key, normalize_fraction, office_label, originator_group, parse_role, party_fraction, speaker_group
from tessera.functions.text import document_numbers, first_token, last_tokens, normalize_name, page_range, period_of, unix_day
from tessera.operators import dedup, intervals, link, sequence
from tessera.operators.aggregates import only_value

Tables = Mapping[str, DataFrame]

# ---------------------------------------------------------------- persons

#: Spellings that differ from the register (last and first name in matching form, and the number meant; fixed values).
ALIASES = {("stegeman", "albert"): "11004415", ("krampe", "jan"): "11005511"}
#: Words before a surname that matching ignores (fixed values).
SURNAME_PREFIXES = "von van de del dos da di zu der la freiherr graf".split()


def _surname(c: Column) -> Column:
    """Matching form of a surname: places in brackets and prefixes go."""
    bare = normalize_name(F.regexp_replace(c, r"\s*\(.*?\)", ""))
    return F.regexp_replace(bare, "^((" + "|".join(SURNAME_PREFIXES) + ") )+", "")


def match_persons(probes: DataFrame, probe_id: str, last: str, first: str, year: str | None, persons: DataFrame, mandates: DataFrame, period: int, voters: bool = False) -> DataFrame:
    """probe_id to matched_id (J9): aliases, then members of the period, then everyone; in each, full first names, the
    first of them, and the last word of a surname of several. A name that no single person bears gives null.

    ``voters`` leaves placeholders out. Names are matched once for each distinct one, not for each row.
    """
    if voters:
        persons = persons.where(~F.startswith("id", F.lit("pdf-")))
    index = persons.select(F.col("id").alias("_id"), normalize_name(F.col("last_name")).alias("_l"), normalize_name(F.col("first_name")).alias("_f"), F.year("birth_date").alias("_y"))
    members = index.join(mandates.where(F.col("wahlperiode") == period).select(F.col("person_id").alias("_id")).distinct(), "_id", "left_semi")
    born = F.col(year).try_cast("int") if year else F.lit(None).cast("int")
    p = probes.select(F.col(probe_id), _surname(F.col(last)).alias("_pl"), normalize_name(F.col(last)).alias("_raw"), normalize_name(F.col(first)).alias("_pf"), born.alias("_y"))
    names = p.select("_pl", "_raw", "_pf", "_y").distinct().withColumn("_probe_no", F.xxhash64("_pl", "_raw", "_pf", F.coalesce("_y", F.lit(-1))))
    key = lambda l, f: F.concat_ws("|", l, f)
    several = F.when(F.contains("_pl", F.lit(" ")), key(last_tokens(F.col("_pl"), 1), first_token(F.col("_pf"))))
    steps = []
    for rows in (members, index):
        steps += [
            (key("_pl", "_pf"), rows, key("_l", "_f")),
            (key(F.col("_pl"), first_token(F.col("_pf"))), rows, key(F.col("_l"), first_token(F.col("_f")))),
            (several, rows, key(F.col("_l"), first_token(F.col("_f")))),
        ]
    found = link.cascade(names, "_probe_no", "_y", steps, "_id", "_y")
    alias = F.create_map(*(F.lit(x) for (l, f), i in ALIASES.items() for x in (f"{l}|{f}", i)))
    resolved = names.join(found, "_probe_no", "left").select("_pl", "_raw", "_pf", "_y", F.coalesce(F.try_element_at(alias, key("_raw", "_pf")), "matched_id").alias("matched_id"))
    same = reduce(lambda a, b: a & b, [p[c].eqNullSafe(resolved[c]) for c in ("_pl", "_raw", "_pf", "_y")])
    return p.join(resolved, same, "left").select(probe_id, "matched_id")


def with_person(df: DataFrame, matched: DataFrame, key: str, to: str = "person_id") -> DataFrame:
    return df.join(matched.withColumnRenamed("matched_id", to), key, "left")


def by_external_id(df: DataFrame, column: str, persons: DataFrame) -> DataFrame:
    """person_id by another register's id; of two persons with the same one the smaller id counts (K6)."""
    ids = persons.where(F.col("dip_person_id").isNotNull()).groupBy(F.col("dip_person_id").alias(column)).agg(F.min("id").alias("person_id"))
    return df.drop("person_id").join(ids, column, "left")


def match_elected(candidates: DataFrame, persons: DataFrame, mandates: DataFrame, period: int) -> DataFrame:
    """position to matched_id (J11): all given names together, then each later one, then the only member born in
    the same year who shares a word of the surname."""
    given = F.split(F.col("first_names"), r"[\s-]+")
    tries = F.concat(F.array("first_names"), F.slice(given, F.lit(2), F.greatest(F.size(given) - 1, F.lit(0))))
    each = candidates.select("position", "last_name", "birth_year", F.posexplode(tries).alias("nth", "try")).withColumn("try_id", F.concat_ws("/", "position", "nth"))
    hits = match_persons(each, "try_id", "last_name", "try", "birth_year", persons, mandates, period)
    by_name = each.join(hits, "try_id").where("matched_id IS NOT NULL").groupBy("position").agg(F.min_by("matched_id", "nth").alias("by_name"))
    words = lambda c: F.explode(F.array_distinct(F.split(normalize_name(F.col(c)), " ")))
    members = persons.join(mandates.where(F.col("wahlperiode") == period).select(F.col("person_id").alias("id")).distinct(), "id", "left_semi")
    m = members.select("id", F.year("birth_date").alias("birth_year"), words("last_name").alias("word"))
    c = candidates.select("position", "birth_year", words("last_name").alias("word"))
    shared = c.join(m, ["birth_year", "word"]).groupBy("position").agg(only_value(F.col("id")).alias("by_word"))
    return candidates.select("position").join(by_name, "position", "left").join(shared, "position", "left").select("position", F.coalesce("by_name", "by_word").alias("matched_id"))


def retired(persons: DataFrame, tables: Tables, prefix: str = "pdf-") -> DataFrame:
    """Placeholders that no table refers to any more (P30); portraits and aliases do not keep one."""
    from tessera.operators.checks import unreferenced
    from tessera.plans.schemas import TABLES

    uses = [(tables[n], c) for n, t in TABLES.items() if n in tables and n not in ("person_photo", "person_alias") for c, (p, _) in t.references.items() if p == "person"]
    return unreferenced(persons.where(F.startswith("id", F.lit(prefix))), "id", uses)


# ---------------------------------------------------------------- documents and procedures

DIP = "https://search.dip.bundestag.de/api/v1"
#: Activities on a document that are no authorship (fixed values).
NOT_AUTHORS = ("Berichterstattung", "Antwort")
QUESTION_TYPES = ("Schriftliche Frage", "Mündliche Frage")


def documents(records: DataFrame) -> DataFrame:
    """Documents out of list records, the newest copy of each."""
    r = dedup.latest(records, ["id"], "retrieved_at", "path")
    return r.select(
        "id", F.col("dokumentnummer").alias("number"), "wahlperiode", F.col("drucksachetyp").alias("type"), F.col("titel").alias("title"),
        F.to_date("datum").alias("date"), F.col("fundstelle.pdf_url").alias("pdf_url"), F.col("herausgeber").alias("publisher"),
        F.coalesce(F.col("urheber.titel"), F.array().cast("array<string>")).alias("originators"), F.col("autoren_anzahl").alias("author_count"),
        F.concat(F.lit(f"{DIP}/drucksache/"), "id").alias("source_url"), F.concat(F.lit("BT-Drs. "), "dokumentnummer").alias("source_document_id"), "retrieved_at",
    )


def authors(activities: DataFrame) -> DataFrame:
    """One activity a person and document, the last in the file (P9). ``activities``: drucksache_id, position and the record."""
    last = dedup.best_row(activities.where("person_id IS NOT NULL"), ["drucksache_id", "person_id"], [F.col("position").desc()])
    return last.select(
        F.concat_ws("/", "drucksache_id", "person_id").alias("id"), "drucksache_id", F.col("person_id").alias("dip_person_id"),
        F.col("titel").alias("name"), F.col("aktivitaetsart").alias("activity_type"),
    )


def counted_authors(docs: DataFrame, author_rows: DataFrame) -> DataFrame:
    """The number of authors by activities where they are known and differ from what the document says."""
    n = author_rows.groupBy(F.col("drucksache_id").alias("id")).agg(F.count_if(~F.col("activity_type").isin(*NOT_AUTHORS)).cast("int").alias("_n"))
    return docs.join(n, "id", "left").withColumn("author_count", F.when(F.col("_n").isNotNull() & (F.col("_n") != F.coalesce("author_count", F.lit(0))), F.col("_n")).otherwise(F.col("author_count"))).drop("_n")


def question_activities(activities: DataFrame) -> DataFrame:
    """Who asked and answered: activities of a person that refer to exactly one question (P10)."""
    refs = F.filter("vorgangsbezug", lambda v: v["vorgangstyp"].isin(*QUESTION_TYPES))
    parts = F.split("titel", ", ")
    tail = F.nullif(F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), ", "), F.lit(""))
    one = activities.withColumn("_refs", refs).where((F.size("_refs") == 1) & F.col("person_id").isNotNull())
    return dedup.best_row(one, ["id"], [F.col("path").desc()]).select(
        "id", F.get("_refs", 0)["id"].alias("vorgang_id"), F.get("_refs", 0)["vorgangstyp"].alias("question_type"), F.col("aktivitaetsart").alias("activity_type"),
        F.col("person_id").alias("dip_person_id"), F.col("titel").alias("name"), F.when(F.col("aktivitaetsart") == "Antwort", tail).alias("ressort"),
        F.coalesce("fundstelle.dokumentart", F.lit("Drucksache")).alias("document_kind"), F.col("fundstelle.dokumentnummer").alias("document_number"),
        F.col("fundstelle.frage_nummer").alias("question_numbers"), F.col("fundstelle.seite").alias("page"),
    )


def procedure_steps(records: DataFrame) -> DataFrame:
    """Steps of procedures out of list records of all chambers."""
    r = dedup.latest(records, ["id"], "retrieved_at", "path")
    f = F.col("fundstelle")
    json_of = lambda c: F.when(F.size(c) > 0, F.to_json(c))
    return r.select(
        "id", "vorgang_id", F.to_date("datum").alias("date"), F.col("vorgangsposition").alias("position"), F.col("zuordnung").alias("chamber"),
        F.coalesce(f["dokumentart"], F.col("dokumentart")).alias("document_kind"), f["dokumentnummer"].alias("document_number"),
        f["drucksachetyp"].alias("document_type"), f["pdf_url"].alias("pdf_url"), page_range(f["anfangsseite"], f["endseite"]).alias("pages"),
        F.coalesce(F.col("urheber.titel"), F.array().cast("array<string>")).alias("originators"), json_of(F.col("ressort")).alias("ressort"),
        json_of(F.col("beschlussfassung")).alias("decisions"), F.concat(F.lit(f"{DIP}/vorgangsposition/"), "id").alias("source_url"),
        F.concat(F.lit("DIP Vorgangsposition "), "id").alias("source_document_id"), "retrieved_at",
    )


def referrals(records: DataFrame) -> DataFrame:
    """Committees that a step refers to: one row each, leading if any mention says so, the rest from the first."""
    u = records.select(F.col("id").alias("position_id"), "vorgang_id", F.posexplode("ueberweisung").alias("n", "u")).where("u.ausschuss IS NOT NULL AND u.ausschuss <> ''")
    return u.groupBy("position_id", F.col("u.ausschuss").alias("committee")).agg(
        F.min("vorgang_id").alias("vorgang_id"), F.min_by(F.col("u.ausschuss_kuerzel"), "n").alias("committee_short"),
        F.coalesce(F.max(F.col("u.federfuehrung").cast("boolean")), F.lit(False)).alias("lead"), F.min_by(F.col("u.ueberweisungsart"), "n").alias("kind"),
    )


def link_votes_to_steps(votes: DataFrame, records: DataFrame, procedures: DataFrame) -> DataFrame:
    """Roll calls with the register's decision of the same day and order, where both sides have as many; else with
    the document number in their title (P13, J14)."""
    b = dedup.latest(records, ["id"], "retrieved_at", "path").select(F.to_date("datum").alias("date"), "vorgang_id", F.explode("beschlussfassung").alias("b")).where("b.abstimmungsart = 'Namentliche Abstimmung'")
    page = F.coalesce(F.regexp_extract("b.seite", r"^(\d+)", 1).try_cast("int"), F.lit(0))
    steps = b.select("date", "vorgang_id", F.col("b.dokumentnummer").alias("step_number"), page.alias("page"), F.regexp_extract("b.seite", r"^\d+([A-D]?)", 1).alias("quarter"))
    paired = link.positional(votes.select("id", "date", "number"), steps, ["date"], ["number"], ["page", "quarter", "step_number", "vorgang_id"], ["id"], ["step_number", "vorgang_id"])
    known = procedures.select(F.col("id").alias("vorgang_id"), F.lit(True).alias("_known"))
    paired = paired.join(known, "vorgang_id", "left").select("id", "step_number", F.when(F.col("_known"), F.col("vorgang_id")).alias("_vorgang"), F.lit(True).alias("_paired"))
    titled = F.get(document_numbers(F.col("title")), 0)
    v = votes.drop("drucksache_number", "vorgang_id", "link_method").join(paired, "id", "left")
    return v.withColumns({
        "drucksache_number": F.when(F.col("_paired"), F.col("step_number")).otherwise(titled),
        "vorgang_id": F.col("_vorgang"),
        "link_method": F.when(F.col("_paired"), "dip_beschluss").when(titled.isNotNull(), "title_regex"),
    }).drop("_paired", "_vorgang", "step_number")


def procedures_of_numbers(t: Tables) -> DataFrame:
    """Document number to its procedures (J19): not the other chamber's documents, nor notices that several share."""
    crowd = t["vorgang_drucksache"].groupBy("drucksache_id").agg(F.count("*").alias("_shared"))
    d = t["drucksache"].where(F.coalesce("publisher", F.lit("BT")) == "BT").select(F.col("id").alias("drucksache_id"), "number", "type")
    known = t["vorgang"].select(F.col("id").alias("vorgang_id"))
    linked = t["vorgang_drucksache"].join(known, "vorgang_id", "left_semi").join(d, "drucksache_id").join(crowd, "drucksache_id")
    return linked.where(~((F.col("type") == "Unterrichtung") & (F.col("_shared") > 1))).select("number", "vorgang_id").distinct()


def item_documents(t: Tables) -> DataFrame:
    """Documents of items and sub-items with their only procedure (P20): those of a sub-item are not repeated on its
    item, and those that only a decision names are added with ``via`` decision."""
    only = procedures_of_numbers(t).groupBy(F.col("number").alias("drucksache_number")).agg(only_value(F.col("vorgang_id")).alias("vorgang_id"))
    subs = t["agenda_sub_item"].select("agenda_item_id", F.col("id").alias("sub_item_id"), F.explode("drucksache_numbers").alias("drucksache_number"))
    items = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), F.explode("drucksache_numbers").alias("drucksache_number"))
    outside = items.join(subs, ["agenda_item_id", "drucksache_number"], "left_anti").withColumn("sub_item_id", F.lit(None).cast("string"))
    titled = subs.unionByName(outside).distinct()
    decided = t["decision"].where("agenda_item_id IS NOT NULL").select("agenda_item_id", "sub_item_id", F.explode(document_numbers(F.col("drucksache_number"))).alias("drucksache_number")).distinct()
    decided = decided.join(titled, ["agenda_item_id", "drucksache_number"], "left_anti")
    both = titled.withColumn("via", F.lit("title")).unionByName(decided.withColumn("via", F.lit("decision")))
    return both.join(only, "drucksache_number", "left").withColumn("id", F.concat_ws("/", F.coalesce("sub_item_id", "agenda_item_id"), "drucksache_number"))


def decision_procedures(t: Tables) -> DataFrame:
    """Procedures of decisions, the most precise way first (J20, P20): the roll call's, steps of the sitting that decide
    one of the documents, else the documents'. A decision that names no document and has no roll call takes those of
    its item's title, and their procedure only if it is the only one."""
    d = t["decision"].select(F.col("id").alias("decision_id"), "sitting_id", "drucksache_number", "roll_call_vote_id", F.coalesce("sub_item_id", "agenda_item_id").alias("owner"))
    v = t["roll_call_vote"].select(F.col("id").alias("roll_call_vote_id"), F.col("vorgang_id").alias("_vote_vorgang"), F.col("drucksache_number").alias("_vote_number"))
    d = d.join(v, "roll_call_vote_id", "left").withColumn("_own", document_numbers(F.coalesce("drucksache_number", F.lit(""))))
    nameless = (F.size("_own") == 0) & F.col("roll_call_vote_id").isNull()
    titled = t["agenda_item_vorlage"].where("via = 'title'").select(F.coalesce("sub_item_id", "agenda_item_id").alias("owner"), F.col("drucksache_number").alias("number"))
    named = d.select("decision_id", "sitting_id", F.explode("_own").alias("number"))
    from_item = d.where(nameless).select("decision_id", "sitting_id", "owner").join(titled, "owner").select("decision_id", "sitting_id", "number")
    steps = decision_steps(t)
    by_step = named.unionByName(from_item).join(steps, ["sitting_id", "number"]).select("decision_id", "vorgang_id")
    of = procedures_of_numbers(t)
    single = from_item.join(of, "number").groupBy("decision_id").agg(only_value(F.col("vorgang_id")).alias("vorgang_id")).where("vorgang_id IS NOT NULL")
    also = d.where(~nameless).select("decision_id", F.explode(F.array_distinct(F.concat("_own", document_numbers(F.coalesce("_vote_number", F.lit("")))))).alias("number"))
    ways = [
        ("roll_call", d.where("_vote_vorgang IS NOT NULL").select("decision_id", F.col("_vote_vorgang").alias("vorgang_id"))),
        ("dip_step", by_step),
        ("agenda_item", single),
        ("drucksache", also.join(of, "number").select("decision_id", "vorgang_id")),
    ]
    ranked = reduce(DataFrame.unionByName, [w.distinct().withColumns({"_rank": F.lit(k), "via": F.lit(n)}) for k, (n, w) in enumerate(ways)])
    best = ranked.groupBy("decision_id").agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["decision_id", "_rank"]).select("decision_id", "vorgang_id", "via")


def decision_steps(t: Tables) -> DataFrame:
    """The register's decisions in a sitting by document number."""
    from tessera.plans.queries import DECISIONS

    p = t["vorgang_position"].where("chamber = 'BT' AND document_kind = 'Plenarprotokoll'").join(t["vorgang"].select(F.col("id").alias("vorgang_id")), "vorgang_id", "left_semi")
    b = p.select(F.col("document_number").alias("sitting_id"), F.col("id").alias("dip_position_id"), "vorgang_id", F.explode(F.from_json("decisions", DECISIONS)).alias("b"))
    return b.select("sitting_id", "dip_position_id", "vorgang_id", F.col("b.beschlusstenor").alias("dip_result"), F.explode(document_numbers(F.coalesce("b.dokumentnummer", F.lit("")))).alias("number"))


def decided_columns(t: Tables, links: DataFrame) -> DataFrame:
    """decision with its only procedure, and the register's step and wording if there is just one."""
    only = links.groupBy(F.col("decision_id").alias("id")).agg(only_value(F.col("vorgang_id")).alias("vorgang_id"))
    named = t["decision"].select("id", "sitting_id", F.explode(document_numbers(F.coalesce("drucksache_number", F.lit("")))).alias("number"))
    hits = named.join(decision_steps(t), ["sitting_id", "number"]).select("id", F.struct("dip_position_id", "dip_result").alias("s")).distinct()
    one = hits.groupBy("id").agg(F.count("*").alias("_n"), F.first("s").alias("_s")).where("_n = 1").select("id", F.col("_s.dip_position_id").alias("dip_position_id"), F.col("_s.dip_result").alias("dip_result"))
    return t["decision"].drop("vorgang_id", "dip_position_id", "dip_result").join(only, "id", "left").join(one, "id", "left")


def votes_to_items(t: Tables) -> DataFrame:
    """roll_call_vote with its decision's item, else the first item of the sitting that shares a document."""
    by_decision = t["decision"].where("roll_call_vote_id IS NOT NULL").groupBy(F.col("roll_call_vote_id").alias("id")).agg(F.max_by("agenda_item_id", "position").alias("_decided"))
    v = t["roll_call_vote"].select("id", "sitting_id", F.explode(document_numbers(F.coalesce("drucksache_number", F.lit("")))).alias("number"))
    items = t["agenda_item"].select(F.col("id").alias("item"), "sitting_id", "position", F.explode("drucksache_numbers").alias("number"))
    first = v.join(items, ["sitting_id", "number"]).groupBy("id").agg(F.min_by("item", "position").alias("_listed"))
    return t["roll_call_vote"].drop("agenda_item_id").join(by_decision, "id", "left").join(first, "id", "left").withColumn("agenda_item_id", F.coalesce("_decided", "_listed")).drop("_decided", "_listed")


def question_status(t: Tables) -> DataFrame:
    """How complete the texts of each question are (A18, P17): inquiries by their newest answer, spoken ones by the
    report, written ones by what was found."""
    q = t["question_text"]
    answers = t["vorgang_drucksache"].join(t["drucksache"].where("type = 'Antwort'").select(F.col("id").alias("drucksache_id"), "number"), "drucksache_id")
    number = F.split("number", "/")[1].try_cast("int")
    newest = answers.groupBy("vorgang_id").agg(F.max_by("number", number).alias("number"))
    asked = q.where("part = 'frage' AND source_document_id LIKE 'BT-Drs. %'").select("source_document_id", "number")
    said = q.where("part = 'antwort'").select("source_document_id", "number").distinct().withColumn("_a", F.lit(True))
    per_doc = asked.join(said, ["source_document_id", "number"], "left").groupBy("source_document_id").agg(F.count("*").alias("n"), F.count("_a").alias("done"))
    v = t["vorgang"].where("type IN ('Kleine Anfrage', 'Große Anfrage')").select(F.col("id").alias("vorgang_id")).join(newest, "vorgang_id", "left")
    v = v.withColumn("source_document_id", F.when(F.col("number").isNotNull(), F.concat(F.lit("BT-Drs. "), "number"))).join(per_doc, "source_document_id", "left")
    n, done = F.coalesce("n", F.lit(0)), F.coalesce("done", F.lit(0))
    status = F.when(F.col("source_document_id").isNull(), "unanswered").when(n == 0, "failed").when(n == done, "complete").otherwise("partial")
    inquiries = v.select("vorgang_id", status.alias("status"), n.cast("int").alias("questions"), done.cast("int").alias("answered"), "source_document_id")
    replied = q.where("part = 'antwort'").select("vorgang_id").distinct().withColumn("_a", F.lit(True))
    spoken = q.where("part = 'frage' AND vorgang_id IS NOT NULL AND source_document_id LIKE 'BT-PlPr. %'").join(replied, "vorgang_id", "left").groupBy("vorgang_id").agg(
        F.count("*").cast("int").alias("questions"), F.count_if(F.col("thread_id").isNotNull() | F.col("_a").isNotNull()).cast("int").alias("answered"), F.max("source_document_id").alias("source_document_id")
    ).withColumn("status", F.when(F.col("answered") > 0, "complete").otherwise("unanswered"))
    there = q.groupBy("vorgang_id").agg(F.max((F.col("part") == "frage").cast("int")).alias("questions"), F.max((F.col("part") == "antwort").cast("int")).alias("answered"))
    doc = t["question_activity"].where("document_kind = 'Drucksache'").groupBy("vorgang_id").agg(F.concat(F.lit("BT-Drs. "), F.max("document_number")).alias("source_document_id"))
    w = t["vorgang"].where("type = 'Schriftliche Frage'").select(F.col("id").alias("vorgang_id")).join(there, "vorgang_id", "left").join(doc, "vorgang_id", "left").na.fill(0, ["questions", "answered"])
    written = w.withColumn("status", F.when(F.col("answered") > 0, "complete").when(F.col("questions") > 0, "unanswered").otherwise("failed"))
    columns = ["vorgang_id", "status", "questions", "answered", "source_document_id"]
    return dedup.first_of_sources([written.select(columns), spoken.select(columns), inquiries.select(columns)], ["vorgang_id"])


# ---------------------------------------------------------------- profiles, side jobs, articles

#: Codes of side jobs: category, range of income by level, and how often (fixed values).
JOB_CATEGORIES = {
    "29231": "Beteiligung an Kapital- oder Personengesellschaften",
    "29647": "Entgeltliche Tätigkeiten neben dem Mandat",
    "29229": "Funktionen in Körperschaften und Anstalten des öffentlichen Rechts",
    "29228": "Funktionen in Unternehmen",
    "29230": "Funktionen in Vereinen, Verbänden und Stiftungen",
    "29232": "Spenden/Zuwendungen für politische Tätigkeit",
    "29233": "Vereinbarungen über künftige Tätigkeiten oder Vermögensvorteile",
    "29234": "Berufliche Tätigkeit vor der Mitgliedschaft im Deutschen Bundestag",
}
INCOME_BOUNDS = ("1", "1.000", "3.500", "7.000", "15.000", "30.000", "50.000", "75.000", "100.000", "150.000", "250.000")
JOB_INTERVALS = {"0": "einmalig", "1": "monatlich", "2": "jährlich"}
#: First sitting of a period (fixed values).
PERIODS = (("2021-10-26", 20), ("2025-03-25", 21))


def _map(values: Mapping) -> Column:
    return F.create_map(*(F.lit(x) for p in values.items() for x in p))


def side_jobs(records: DataFrame, mandates: DataFrame, profiles: DataFrame) -> DataFrame:
    """Side jobs of a period's members (P22): the first mandate of the list that is one of the period's, else the first.

    ``records`` have a wahlperiode column; ``mandates`` are (aw_mandate_id, aw_politician_id).
    """
    ranges = {k: f"{a} € bis {b} €" for k, (a, b) in enumerate(zip(INCOME_BOUNDS, INCOME_BOUNDS[1:], strict=False))} | {len(INCOME_BOUNDS) - 1: f"ab {INCOME_BOUNDS[-1]} €"}
    listed = records.select("id", F.posexplode("mandates.id").alias("n", "aw_mandate_id")).join(mandates, "aw_mandate_id", "left")
    order = F.struct(F.col("aw_politician_id").isNull(), "n")
    chosen = listed.groupBy("id").agg(F.min_by(F.struct("aw_mandate_id", "aw_politician_id"), order).alias("m")).select("id", "m.*")
    known = profiles.where("person_id IS NOT NULL").select("aw_politician_id", "person_id")
    level = F.col("income_level").try_cast("int")
    return records.join(chosen, "id", "left").join(known, "aw_politician_id", "left").select(
        "id", "wahlperiode", "person_id", "aw_mandate_id", "label", "job_title_extra",
        F.coalesce(F.try_element_at(_map(JOB_CATEGORIES), F.coalesce("category", F.lit(""))), "category").alias("category"),
        level.alias("income_level"), F.try_element_at(_map(ranges), level).alias("income_range"), "income",
        F.try_element_at(_map(JOB_INTERVALS), F.coalesce("interval", F.lit(""))).alias("interval"), "additional_information",
        F.col("sidejob_organization.id").alias("organization_id"), F.col("sidejob_organization.label").alias("organization"),
        F.col("field_city.label").alias("city"), F.coalesce(F.col("field_topics.label"), F.array().cast("array<string>")).alias("topics"),
        unix_day(F.col("created")).alias("created"), F.to_date("data_change_date").alias("data_change_date"), F.col("api_url").alias("source_url"),
        F.concat(F.lit("aw sidejob "), F.col("id").cast("string")).alias("source_document_id"), "retrieved_at",
    )


def articles(parsed: DataFrame, committees: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """News articles with period and committee, and their documents in order (P29). Older ones than the first period are left out."""
    from tessera.sources.web import committee

    period = period_of(F.col("date"), PERIODS)
    of = F.when(F.col("kind").isin("Ausschuss", "Anhörung"), committee(F.col("text"), F.col("ressort"), committees))
    items = parsed.withColumns({"wahlperiode": period, "committee": of}).where("wahlperiode IS NOT NULL")
    links = items.select(F.col("id").alias("hib_id"), F.posexplode("drucksachen").alias("n", "drucksache_number")).withColumn("position", F.col("n") + 1).drop("n")
    return items.drop("drucksachen"), links


# ---------------------------------------------------------------- government

OFFICE_SOURCES = ("wikidata", "stammdaten", "protocol")
DEPARTMENT_SOURCES = ("wikidata", "protocol", "stammdaten")


def membership_offices(t: Tables, since: str) -> DataFrame:
    """Offices out of memberships: a function without a department at an institution (P25)."""
    role = parse_role(F.col("role"))
    m = t["membership"].where(F.col("kind") == "other").where(F.col("from_date") >= since).withColumn("r", role)
    m = m.where(F.col("r").isNotNull() & (F.col("r.department").isNull() | (F.col("r.kind") == "kanzler")))
    p = t["person"].select(F.col("id").alias("person_id"), F.concat_ws(" ", "first_name", "last_name").alias("holder"), "wikidata_qid")
    return m.join(p, "person_id").select(
        F.lit("stammdaten").alias("source_kind"), "person_id", F.col("holder").alias("name"), F.col("r.kind").alias("kind"),
        F.coalesce("r.department", "name").alias("department"), "from_date", "to_date", "wikidata_qid", "source_url", "source_document_id", "retrieved_at",
    )


def spoken_offices(t: Tables, since: str) -> DataFrame:
    """Offices printed with speakers: first and last day, provenance of the first."""
    p = t["person"].select(F.col("id").alias("person_id"), F.concat_ws(" ", "first_name", "last_name").alias("name"), "wikidata_qid", F.when(~F.col("is_mdb"), F.col("role")).alias("_role"))
    st = t["sitting"].where(F.col("date") >= since).select(F.col("id").alias("sitting_id"), "date")
    s = t["speech"].join(st, "sitting_id").join(p, "person_id").withColumn("r", parse_role(F.coalesce("speaker_role", "_role"))).where("r.department IS NOT NULL")
    first = lambda c: F.min_by(c, F.struct("date", "sitting_id", "position")).alias(c)
    return s.groupBy("person_id", F.col("r.kind").alias("kind"), department_key(F.col("r.department")).alias("_key")).agg(
        F.min("date").alias("from_date"), F.max("date").alias("to_date"), F.min_by(F.col("r.department"), F.struct("date", "sitting_id", "position")).alias("department"),
        *(first(c) for c in ("name", "wikidata_qid", "source_url", "source_document_id", "retrieved_at")),
    ).drop("_key").withColumn("source_kind", F.lit("protocol"))


def government_roles(evidence: DataFrame) -> DataFrame:
    """One row a person, kind and department (P26, A13-A15): dates from the best source, the department's name by
    another order, open offices of a single holder closed by the next holder who speaks."""
    e = evidence.withColumn("_key", department_key(F.col("department")))
    for c in ("id", "office"):
        e = e if c in e.columns else e.withColumn(c, F.lit(None).cast("string"))
    names = e.where("department IS NOT NULL").groupBy("_key").agg(F.min_by("department", F.struct(intervals.rank_of("source_kind", DEPARTMENT_SOURCES), "from_date")).alias("_named"))
    carry = ["id", "name", "office", "wikidata_qid", "source_url", "source_document_id", "retrieved_at"]
    per_source = intervals.combine(e, ["person_id", "kind", "_key", "source_kind"], "from_date", "to_date", carry)
    wiki = per_source.where("source_kind = 'wikidata'").select("person_id", "kind", "_key", F.col("name").alias("_wname"), F.col("office").alias("_woffice"), F.col("wikidata_qid").alias("_wqid"))
    merged = intervals.merge_by_rank(per_source, ["person_id", "kind", "_key"], "source_kind", OFFICE_SOURCES, ["from_date", "to_date", *carry])
    rows = merged.join(wiki, ["person_id", "kind", "_key"], "left").join(names, "_key", "left").withColumn("department", F.when(F.col("_key") != "", F.col("_named")))
    later = e.where("source_kind = 'protocol' AND _key <> ''").groupBy("kind", "_key", "person_id").agg(F.min("from_date").alias("from_date"))
    closable = F.col("kind").isin("kanzler", "minister") & (F.col("source_kind") != "protocol") & (F.col("_key") != "")
    closed = intervals.close_by_successor(rows.where(closable), later, ["kind", "_key"], "person_id", "from_date", "to_date").drop("successor")
    made_id = F.concat_ws(":", "source_kind", "person_id", "kind", F.coalesce(F.nullif("_key", F.lit("")), F.lit("-")))
    return closed.unionByName(rows.where(~closable)).select(
        F.when(F.col("source_kind") == "wikidata", F.col("id")).otherwise(made_id).alias("id"), "person_id", F.coalesce("_wqid", "wikidata_qid").alias("wikidata_qid"),
        F.coalesce("_wname", "name").alias("name"), F.coalesce("_woffice", office_label(F.col("kind"), F.col("department"))).alias("office"), "department", "kind",
        "from_date", "to_date", "source_kind", "source_url", "source_document_id", "retrieved_at",
    )


# ---------------------------------------------------------------- groups and parts of speeches

NO_GROUP = "fraktionslos"
#: Beginnings of an item's title and its kind (fixed values).
ITEM_KINDS = (("befragung", "Befragung der Bundesregierung"), ("fragestunde", "Fragestunde"), ("aktuelle_stunde", "Aktuelle Stunde"))


def speech_groups(t: Tables) -> DataFrame:
    """speech with the group it counts for and the member's own group that day (P31, J6): the membership that covers
    the day and starts last, else the latest one, else the printed one, else none for a member."""
    st = t["sitting"].select(F.col("id").alias("sitting_id"), "wahlperiode", "date")
    p = t["person"].select(F.col("id").alias("person_id"), F.when(~F.col("is_mdb"), F.col("role")).alias("_role"))
    s = t["speech"].drop("speaker_group", "member_fraction").join(st, "sitting_id").join(p, "person_id", "left")
    m = t["membership"].where("kind = 'fraction'").select("person_id", "wahlperiode", F.col("name").alias("_name"), F.coalesce("from_date", F.lit("0001-01-01").cast("date")).alias("_from"), F.col("to_date").alias("_to"))
    days = s.select("person_id", "wahlperiode", "date").distinct()
    on_day = link.covering(days, m, ["person_id", "wahlperiode"], "date", "_from", "_to").groupBy("person_id", "wahlperiode", "date").agg(F.max_by("_name", "_from").alias("_on_day"))
    latest = m.groupBy("person_id", "wahlperiode").agg(F.max_by("_name", "_from").alias("_latest"))
    member = t["mandate"].select("person_id", "wahlperiode").distinct().withColumn("_member", F.lit(NO_GROUP))
    joined = s.join(on_day, ["person_id", "wahlperiode", "date"], "left").join(latest, ["person_id", "wahlperiode"], "left").join(member, ["person_id", "wahlperiode"], "left")
    return joined.withColumns({
        "speaker_group": speaker_group(F.coalesce("speaker_role", "_role"), F.col("fraction")),
        "member_fraction": F.coalesce("_on_day", "_latest", normalize_fraction(F.col("fraction")), "_member"),
    }).drop("wahlperiode", "date", "_role", "_on_day", "_latest", "_member")


def person_groups(t: Tables) -> DataFrame:
    """person with the group of the latest period (P31): the open membership, the latest, the last printed, none for a member."""
    newest = t["mandate"].agg(F.max("wahlperiode").alias("wahlperiode"))
    members = t["mandate"].join(F.broadcast(newest), "wahlperiode").select("person_id").distinct().withColumn("_member", F.lit(NO_GROUP))
    m = t["membership"].where("kind = 'fraction'").join(F.broadcast(newest), "wahlperiode")
    of = m.groupBy("person_id").agg(F.max_by("name", F.when(F.col("to_date").isNull(), F.coalesce("from_date", F.lit("0001-01-01").cast("date")))).alias("_open"), F.max_by("name", F.coalesce("from_date", F.lit("0001-01-01").cast("date"))).alias("_last"))
    st = t["sitting"].join(F.broadcast(newest), "wahlperiode").select(F.col("id").alias("sitting_id"), "date")
    spoken = t["speech"].where("fraction IS NOT NULL").join(st, "sitting_id").select("person_id", "fraction", "date")
    voted = t["individual_vote"].where("person_id IS NOT NULL").join(t["roll_call_vote"].select(F.col("id").alias("vote_id"), "sitting_id", "date"), "vote_id").join(st.select("sitting_id"), "sitting_id", "left_semi").select("person_id", "fraction", "date")
    printed = spoken.unionByName(voted).groupBy("person_id").agg(normalize_fraction(F.max_by("fraction", "date")).alias("_printed"))
    p = t["person"].drop("fraction").withColumn("person_id", F.col("id"))
    for d in (of, printed, members):
        p = p.join(d, "person_id", "left")
    belongs = F.when(F.col("_member").isNotNull(), F.coalesce("_open", "_last"))
    return p.withColumn("fraction", F.coalesce(belongs, "_printed", "_member")).drop("person_id", "_open", "_last", "_printed", "_member")


def document_groups(docs: DataFrame) -> DataFrame:
    """drucksache with the distinct groups of its originators in order."""
    return docs.withColumn("originator_groups", dedup.distinct_in_order(F.transform("originators", originator_group)))


def party_map(t: Tables) -> DataFrame:
    """Every party that any table names, with the group it sits in."""
    names = t["person"].select("party").union(t["election_candidacy"].select("party")).union(t["constituency"].select("seat_party")).union(t["constituency_result"].where("group_kind = 'party'").select("party"))
    return names.distinct().withColumn("fraction", party_fraction(F.col("party"))).where("fraction IS NOT NULL")


def item_kinds(t: Tables) -> DataFrame:
    """agenda_item with its kind by title or by the turns it holds."""
    by_title = F.lit(None).cast("string")
    for kind, start in reversed(ITEM_KINDS):
        by_title = F.when(F.startswith(F.coalesce("title", F.lit("")), F.lit(start)), kind).otherwise(by_title)
    turns = t["speech"].where("kind = 'fragestunde'").select(F.col("agenda_item_id").alias("id")).distinct().withColumn("_turns", F.lit("fragestunde"))
    return t["agenda_item"].join(turns, "id", "left").withColumn("kind", F.coalesce("_turns", by_title)).drop("_turns")


def speech_parts(t: Tables) -> DataFrame:
    """speech with its printed speech and interruption (P32, W7, W8). Turns of a question time or interview are none."""
    tail = sequence.context(t["speech_paragraph"], ["speech_id"], ["position"], F.when(F.col("kind") == "chair", F.col("text")).otherwise(""), 6, "_tail")
    said = tail.groupBy("speech_id").agg(F.max_by("_tail", "position").alias("_tail")).select(F.col("speech_id").alias("id"), F.array_join("_tail", " ").rlike("Kurzintervention|Zwischenbemerkung").alias("_announces"))
    calm = t["agenda_item"].where("kind IN ('befragung', 'fragestunde')").select(F.col("id").alias("agenda_item_id"), F.lit(True).alias("_calm"))
    s = t["speech"].drop("interruption", "interruption_start").withColumn("rede_id", F.when(F.col("kind") == "fragestunde", F.col("id")).otherwise(F.regexp_replace("id", r"-\d+$", "")))
    s = s.join(said, "id", "left").join(calm, "agenda_item_id", "left")
    main = F.first("person_id").over(Window.partitionBy("rede_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    # A question or answer of an interview counts as the main speaker's.
    who = F.when(F.col("_calm"), main).otherwise(F.col("person_id"))
    slim = s.select("rede_id", "id", "position", who.alias("_who"), F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("_words"), F.coalesce("_announces", F.lit(False)).alias("_announces"))
    found = sequence.interruptions(slim, "rede_id", "position", "_who", "id", "_words", "_announces").select("id", "interruption", "interruption_start")
    return s.drop("_announces", "_calm").join(found, "id", "left")


# ---------------------------------------------------------------- sub-items, decisions, questions

def _said(text: Column) -> Column:
    """Lower-cased words and numbers of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def call_up(text: Column) -> Column:
    """The label of a paragraph that is nothing but a call-up (X18): the name of a point and its number at the end, and
    before them at most words of calling up."""
    said = _said(text)
    points, calling = ["tagesordnungspunkt", "zusatzpunkt", "top", "zp"], ["wir", "kommen", "ich", "rufe", "jetzt", "nun", "damit", "zu", "zum", "auf", "den"]
    named = F.filter(said, lambda w: w.isin(points))
    kind = F.when(F.get(named, 0).isin("zusatzpunkt", "zp"), "ZP").otherwise("")
    # "8", "8a" and "8 a": all words behind the point's name are its number.
    behind = F.slice(said, F.array_position(said, F.get(named, 0)).cast("int") + 1, F.size(said))
    number = F.array_join(behind, "")
    before = F.slice(said, 1, F.array_position(said, F.get(named, 0)).cast("int") - 1)
    only = (F.size(named) == 1) & F.forall(before, lambda w: w.isin(calling)) & number.rlike("^[0-9]+[a-z]?$") & ~F.trim(text).rlike("[.!?,;]$")
    return F.when(only, F.concat(kind, number))


def no_debate(text: Column) -> Column:
    """Whether a sentence says that there is no debate, but not of one reading only."""

    def silent(s: Column) -> Column:
        said = _said(s)
        debate = F.exists(said, lambda w: w.isin("aussprache", "debatte"))
        pairs = F.transform(said, lambda w, i: F.concat_ws(" ", w, F.get(said, i + 1)))
        without = F.arrays_overlap(pairs, F.array(*map(F.lit, ("keine aussprache", "ohne aussprache", "keine debatte", "ohne debatte"))))
        planned = F.array_contains(said, "aussprache") & F.array_contains(pairs, "nicht vorgesehen")
        one = F.arrays_overlap(pairs, F.array(F.lit("ersten beratung"), F.lit("zweiten beratung"), F.lit("dritten beratung")))
        return debate & (without | planned) & ~one

    return F.exists(F.split(text, r"(?<=[.!?])\s+"), silent)


def sub_items(paragraphs: DataFrame) -> DataFrame:
    """Items of a block that are called up one by one (W5): at least two labels; a repeated label goes on with its item.

    ``paragraphs`` are those under items with agenda_item_id, position, kind, class, text.
    """
    from tessera.sources.protocol import NOT_TITLE

    w = Window.partitionBy("agenda_item_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    p = paragraphs.withColumn("_label", F.when(F.col("kind") == "chair", call_up(F.col("text"))))
    first = F.row_number().over(Window.partitionBy("agenda_item_id", "_label").orderBy("position")) == 1
    p = p.withColumn("_opens", F.col("_label").isNotNull() & first)
    silent = F.max(F.when(F.col("kind") == "chair", no_debate(F.col("text")).cast("int")).otherwise(0)).over(w)
    b = sequence.blocks(p.withColumn("_silent", silent), ["agenda_item_id"], ["position"], F.col("_opens"), 2, "_block")
    line = F.when((F.col("kind") == "procedural") & F.startswith("class", F.lit("T_")), F.struct("position", "class", "text"))
    lines = F.sort_array(F.collect_list(line))
    made = b.groupBy("agenda_item_id", "_block").agg(
        F.min_by("_label", "position").alias("label"), F.min("position").alias("first_paragraph"), F.max("position").alias("last_paragraph"),
        F.max("_silent").alias("_silent"), lines.alias("_lines"),
    )
    title = F.array_join(F.transform(F.filter("_lines", lambda x: ~x["class"].isin(*NOT_TITLE)), lambda x: x["text"]), " | ")
    numbers = F.array_distinct(F.flatten(F.transform("_lines", lambda x: document_numbers(x["text"]))))
    return made.select(
        F.concat_ws("/", "agenda_item_id", "label").alias("id"), "agenda_item_id", "label", F.col("_block").cast("int").alias("position"), F.nullif(title, F.lit("")).alias("title"),
        numbers.alias("drucksache_numbers"), (F.col("_silent") == 1).alias("no_debate"), "first_paragraph", "last_paragraph",
    )


def speeches_in_sub_items(speeches: DataFrame, paragraphs: DataFrame, subs: DataFrame) -> DataFrame:
    """speech with the sub-item whose span holds the last paragraph before it."""
    p = paragraphs.select("agenda_item_id", (F.col("after_speeches") + 1).alias("position"), F.col("position").alias("_at"))
    last = p.groupBy("agenda_item_id", "position").agg(F.max("_at").alias("_at"))
    placed = link.asof(speeches.drop("sub_item_id"), last, ["agenda_item_id"], "position", ["_at"])
    s = subs.select(F.col("agenda_item_id").alias("_item"), F.col("id").alias("sub_item_id"), "first_paragraph", "last_paragraph")
    inside = (F.col("agenda_item_id") == F.col("_item")) & F.col("_at").between(F.col("first_paragraph"), F.col("last_paragraph"))
    return placed.join(s, inside, "left").drop("_item", "first_paragraph", "last_paragraph", "_at")


DECISIONS = (
    "sitting_id string, id string, agenda_item_id string, n int, position int, kind string, subject string, drucksache_number string, result string, "
    "roll_call_vote_id string, text string, at int, fractions map<string,string>"
)


def decisions(chair: DataFrame, votes: DataFrame, period: int, items: DataFrame | None = None) -> DataFrame:
    """Decisions of each sitting (W10, P18), linked to recorded votes.

    ``chair`` are the chair's paragraphs: sitting_id, agenda_item_id, paragraph (running in
    the sitting), at, text. A sitting is one group, bounded by what is said in a day; the
    sittings before and after it come along, because the totals of a roll call may be read
    out in the next one (J18). With ``items`` (id, top_id, drucksache_numbers) a decision
    goes to the agenda item that it names, by label or by document; else, and without
    them, to the item that it was read under.
    """
    from tessera.functions import decisions as D

    number = F.split("sitting_id", "/")
    order = Window.partitionBy(number[0]).orderBy(number[1].cast("int"), "sitting_id")
    days = chair.select("sitting_id").distinct().withColumns({"next": F.lead("sitting_id").over(order), "last": F.lag("sitting_id").over(order)})
    beside = days.select(
        "sitting_id",
        F.explode(
            F.array(
                F.struct(F.col("sitting_id").alias("group"), F.lit(0).alias("day")),
                F.struct(F.col("next").alias("group"), F.lit(-1).alias("day")),
                F.struct(F.col("last").alias("group"), F.lit(1).alias("day")),
            )
        ).alias("x"),
    ).select("sitting_id", "x.*").where("group IS NOT NULL")
    spoken = chair.select("sitting_id", "agenda_item_id", "paragraph", "at", "text")
    if items is None:
        spoken = spoken.withColumns({"label": F.lit(None).cast("string"), "documents": F.lit(None).cast("array<string>")})
    else:
        named = items.select(F.col("id").alias("agenda_item_id"), F.col("top_id").alias("label"), F.col("drucksache_numbers").alias("documents"))
        spoken = spoken.join(named, "agenda_item_id", "left")
    recorded = votes.select("sitting_id", "id", "number", "yes", "no", "drucksache_number")

    def stream(said: pd.DataFrame) -> list[D.Sentence]:
        said = said.sort_values("paragraph")
        rows = zip(said["agenda_item_id"], said["paragraph"], said["at"], said["text"], strict=True)
        return [D.Sentence(i, int(p), s, None if pd.isna(at) else int(at)) for i, p, at, t in rows for s in D.sentences(t)]

    def run(said: pd.DataFrame, votes: pd.DataFrame) -> pd.DataFrame:
        names = [c.split(" ")[0] for c in DECISIONS.split(", ")]
        own = said[said["day"] == 0] if len(said) else said
        if own.empty:
            return pd.DataFrame(columns=names)
        sitting = own["sitting_id"].iloc[0]
        earlier = D.Reader(period)
        earlier.read(stream(said[said["day"] == -1]))
        totals = votes.set_index("id")[["yes", "no"]].to_dict("index")
        for d, vote in zip(earlier.found, D.link_roll_calls(earlier.found, votes[votes["day"] == -1].to_dict("records")), strict=True):
            if vote and d.counts is None:
                d.counts = (int(totals[vote]["yes"]), int(totals[vote]["no"]), 0)
        reader = D.Reader(period, earlier.waiting)
        found = reader.read(stream(own))
        mine = votes[votes["day"] == 0].to_dict("records")
        linked = D.link_roll_calls(found, mine)
        for d, vote in zip(found, linked, strict=True):
            if vote and d.counts is None:
                d.counts = (int(totals[vote]["yes"]), int(totals[vote]["no"]), 0)
        later = D.Reader(period, [d for d in reader.waiting if any(d is x for x in found)])
        later.read(stream(said[said["day"] == 1]))
        every = own.sort_values("paragraph").drop_duplicates("agenda_item_id")
        known = [(i, x or "", [] if n is None else list(n)) for i, x, n in zip(every["agenda_item_id"], every["label"], every["documents"], strict=True)]
        rows, n = [], {"namentlich": 0, "handzeichen": 0}
        places = D.items_of(found, known)
        for k, (d, i, vote, item) in enumerate(zip(found, D.anchored(found, sitting), linked, places, strict=True), start=1):
            n[d.kind] += 1
            result = d.result
            if result is None and vote and totals[vote]["yes"] != totals[vote]["no"]:
                result = D.ADOPTED if totals[vote]["yes"] > totals[vote]["no"] else D.REJECTED
            rows.append((sitting, vote or i, item, n[d.kind], k, d.kind, d.subject, d.number, result, vote, d.text, d.at, d.fractions))
        return pd.DataFrame(rows, columns=names)

    near = spoken.join(beside, "sitting_id").groupBy("group")
    of = beside.select("sitting_id", F.col("group").alias("of"), F.col("day").alias("day_of"))
    recorded = recorded.join(of, "sitting_id").withColumnRenamed("day_of", "day")
    return near.cogroup(recorded.groupBy("of")).applyInPandas(run, DECISIONS)


def chair_words(paragraphs: DataFrame, speech_paragraphs: DataFrame, speeches: DataFrame, items: DataFrame) -> DataFrame:
    """What the chair says in a sitting as one stream (W4): under items and inside speeches, in printed order."""
    order = items.select(F.col("id").alias("agenda_item_id"), "sitting_id", F.col("position").alias("_item"))
    under = paragraphs.where("kind = 'chair' OR (kind = 'procedural' AND text RLIKE '^Drucksachen? [0-9]+/[0-9]+')").join(order, "agenda_item_id").select(
        "sitting_id", "agenda_item_id", F.col("after_speeches").alias("_a"), "_item", F.lit(1).alias("_b"), F.col("position").alias("_c"), F.col("position").alias("at"), "text"
    )
    s = speeches.where("agenda_item_id IS NOT NULL").select(F.col("id").alias("speech_id"), "agenda_item_id", (F.col("position") - 1).alias("_a"))
    inside = speech_paragraphs.where("kind = 'chair'").join(s, "speech_id").join(order, "agenda_item_id").select(
        "sitting_id", "agenda_item_id", "_a", "_item", F.lit(2).alias("_b"), F.col("position").alias("_c"), F.lit(None).cast("int").alias("at"), "text"
    )
    both = under.unionByName(inside).where(~F.col("text").rlike("^(Alters)?(Vize)?[Pp]räsident(in)?\\b.*:$"))
    w = Window.partitionBy("sitting_id").orderBy("_a", "_item", "_b", "_c")
    known = F.last("at", ignorenulls=True).over(Window.partitionBy("sitting_id", "agenda_item_id").orderBy("_a", "_b", "_c").rowsBetween(Window.unboundedPreceding, 0))
    return both.select("sitting_id", "agenda_item_id", F.row_number().over(w).alias("paragraph"), known.alias("at"), "text")


def decisions_in_sub_items(found: DataFrame, subs: DataFrame) -> DataFrame:
    """Decisions with the sub-item last called up where they were read; it lends its only document where none is named."""
    s = subs.select("agenda_item_id", F.col("first_paragraph").alias("at"), F.col("id").alias("sub_item_id"), F.col("drucksache_numbers").alias("_numbers"))
    placed = link.asof(found.drop("sub_item_id"), s, ["agenda_item_id"], "at", ["sub_item_id", "_numbers"])
    only = F.when(F.size("_numbers") == 1, F.get("_numbers", 0))
    return placed.withColumn("drucksache_number", F.coalesce("drucksache_number", only)).drop("_numbers")
