"""The canned queries over the tables. Each takes the tables by name and gives one lazy plan."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import document_numbers, first_page, normalize_name
from tessera.operators import intervals
from tessera.sources.registers import OFFICE_KINDS

Tables = Mapping[str, DataFrame]
Day = str | datetime.date

#: Votes as counted (fixed values).
VOTES = ("yes", "no", "abstain", "invalid", "absent")
#: Activities that make an author (fixed values).
AUTHORSHIP = ("Antrag", "Kleine Anfrage", "Große Anfrage", "Entschließungsantrag", "Änderungsantrag", "Gesetzentwurf", "Frage")
SINGLE_HOLDER = ("kanzler", "minister")
STALE_AFTER = 90


class Unclear(ValueError):
    """No person, or more than one, fits what was asked for."""


def _between(c: str, start: Day, end: Day) -> Column:
    return F.col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def resolve_person(t: Tables, who: str) -> str:
    """Q1: the id of a person by number, full name or last name; more than one is an error that names some."""
    p = t["person"]
    if who.strip().isdigit():
        found = p.where(F.col("id") == who.strip())
    else:
        key = normalize_name(F.lit(who))
        full, last = normalize_name(F.concat_ws(" ", "first_name", "last_name")), normalize_name(F.col("last_name"))
        found = p.where((full == key) | (last == key))
    rows = found.select("id", "first_name", "last_name").limit(6).collect()
    if len(rows) != 1:
        names = ", ".join(f"{r['first_name']} {r['last_name']} ({r['id']})" for r in rows)
        raise Unclear(f"{who!r} fits {'nobody' if not rows else names}")
    return rows[0]["id"]


def speeches(t: Tables, person: str, start: Day, end: Day) -> DataFrame:
    """Q2: a person's speeches in a range of days, in order."""
    s = t["speech"].where(F.col("person_id") == person)
    st = t["sitting"].where(_between("date", start, end)).select(F.col("id").alias("sitting_id"), "date")
    a = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), "top_id", F.col("title").alias("agenda_title"))
    return s.join(st, "sitting_id").join(a, "agenda_item_id", "left").select(
        F.col("id").alias("speech_id"), "date", "sitting_id", "top_id", "agenda_title", "kind", "speaker_role", "fraction", "text",
        "source_url", "source_document_id", "retrieved_at", "position",
    ).orderBy("date", "position")


def votes(t: Tables, person: str, start: Day, end: Day) -> DataFrame:
    """Q3: each roll call of a range with the person's vote and how their group voted; absences count too.

    One plan in place of three statements a vote: counts by group and value, folded into
    a map, met by the person's own rows. Of values as frequent the smaller one leads.
    """
    v = t["roll_call_vote"].where(_between("date", start, end))
    iv = t["individual_vote"].join(v.select(F.col("id").alias("vote_id")), "vote_id", "left_semi")
    own = iv.where(F.col("person_id") == person).select("vote_id", F.col("vote").alias("own_vote"), F.col("fraction").alias("own_fraction"))
    n = iv.groupBy("vote_id", "fraction", "vote").agg(F.count("*").alias("n"))
    line = n.groupBy("vote_id", F.col("fraction").alias("own_fraction")).agg(
        F.min_by("vote", F.struct(-F.col("n"), F.col("vote"))).alias("majority"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("vote", "n")))).alias("counts"),
    )
    result = F.struct(*VOTES).alias("result")
    joined = v.withColumn("vote_id", F.col("id")).join(own, "vote_id", "left").join(line, ["vote_id", "own_fraction"], "left")
    fraction_line = F.when(F.col("own_vote").isNotNull(), F.struct(F.col("own_fraction").alias("fraction"), "majority", "counts"))
    return joined.select(
        "vote_id", "date", "number", "title", "drucksache_number", "vorgang_id", "link_method", result, "own_vote",
        fraction_line.alias("fraction_line"), "source_url", "source_document_id", "pdf_url", "retrieved_at",
    ).orderBy("date", "number")


def documents(t: Tables, person: str, start: Day, end: Day) -> DataFrame:
    """Q4: documents that a person is an author of, by day and number as text."""
    a = t["drucksache_author"].where((F.col("person_id") == person) & F.col("activity_type").isin(*AUTHORSHIP))
    d = t["drucksache"].where(_between("date", start, end)).select(
        F.col("id").alias("drucksache_id"), "number", "date", "type", "title", "pdf_url", "originators", "author_count"
    )
    return a.join(d, "drucksache_id").select(
        "number", "date", "type", "title", "pdf_url", "originators", "author_count", "activity_type", "source_url", "source_document_id", "retrieved_at"
    ).orderBy("date", "number")


def corpus(t: Tables, start: Day, end: Day) -> DataFrame:
    """Q5: one clean speech a row."""
    s = t["speech"].where(F.length("text") > 0)
    st = t["sitting"].where(_between("date", start, end)).select(F.col("id").alias("sitting_id"), "date")
    p = t["person"].select(F.col("id").alias("person_id"), "first_name", "last_name", "is_mdb", "party")
    a = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), "top_id", F.col("title").alias("agenda_title"))
    return s.join(st, "sitting_id").join(p, "person_id").join(a, "agenda_item_id", "left").select(
        F.col("id").alias("speech_id"), "person_id", "first_name", "last_name", "is_mdb", "speaker_role", s["fraction"], "party", "date", "sitting_id",
        "top_id", "agenda_title", "text", s["source_url"], s["source_document_id"], "position",
    ).orderBy("date", "position")


def _held(t: Tables, on: Column) -> DataFrame:
    return intervals.held_on(
        t["government_role"], on, "id", "person_id", ["kind", "department"],
        F.col("kind").isin(*SINGLE_HOLDER), F.col("source_kind") == "protocol", "from_date", "to_date",
    )


def government(t: Tables, on: Day | None = None) -> DataFrame:
    """Q6: offices, or those held on a day, by kind, start, office and name."""
    g = t["government_role"] if on is None else _held(t, F.lit(on).cast("date"))
    p = t["person"].select(F.col("id").alias("person_id"), "is_mdb")
    rank = intervals.rank_of("kind", OFFICE_KINDS)
    return g.join(p, "person_id", "left").withColumn("kind_rank", rank).orderBy("kind_rank", "from_date", "office", "name").drop("kind_rank")


def stale_roles(t: Tables, days: int = STALE_AFTER) -> DataFrame:
    """Q7: offices that count as held but were last seen more than ``days`` before the newest sitting."""
    newest = t["sitting"].agg(F.max("date").alias("newest"))
    role = t["government_role"].join(F.broadcast(newest))
    held = intervals.held_on(
        role, F.col("newest"), "id", "person_id", ["kind", "department"],
        F.col("kind").isin(*SINGLE_HOLDER), F.col("source_kind") == "protocol", "from_date", "to_date",
    ).drop("newest")
    found = intervals.stale(held.where("source_kind = 'protocol'"), newest, "to_date", days)
    return found.withColumnRenamed("newest", "newest_sitting").orderBy("to_date", "name")


def photos(t: Tables) -> DataFrame:
    """Q8: portraits with names."""
    p = t["person"].select(F.col("id").alias("person_id"), "first_name", "last_name")
    return t["person_photo"].join(p, "person_id").orderBy("last_name", "first_name")


def photos_missing(t: Tables) -> DataFrame:
    """Q9: sitting members of the latest period without a portrait, with their latest group."""
    from tessera.operators.checks import not_in

    latest = t["mandate"].agg(F.max("wahlperiode").alias("wahlperiode"))
    m = t["mandate"].where("to_date IS NULL").join(F.broadcast(latest), "wahlperiode").select("person_id", "wahlperiode")
    group = t["membership"].where("kind = 'fraction'").groupBy("person_id", "wahlperiode").agg(F.max_by("name", "from_date").alias("fraction"))
    p = t["person"].select(F.col("id").alias("person_id"), "first_name", "last_name")
    missing = not_in(m, "person_id", t["person_photo"], "person_id")
    return missing.join(p, "person_id").join(group, ["person_id", "wahlperiode"], "left").select(
        "person_id", "first_name", "last_name", "fraction"
    ).orderBy("last_name", "first_name")


def decisions(t: Tables, sitting: str) -> DataFrame:
    """Q10: a sitting's decisions in order, with groups' positions, and totals where there was a roll call."""
    d = t["decision"].where(F.col("sitting_id") == sitting)
    a = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), "top_id", F.col("title").alias("agenda_title"))
    st = t["sitting"].where(F.col("id") == sitting).select(F.col("id").alias("sitting_id"), "date", "pdf_url")
    v = t["roll_call_vote"].select(F.col("id").alias("roll_call_vote_id"), F.struct("yes", "no", "abstain").alias("totals"))
    f = t["decision_fraction"].groupBy(F.col("decision_id").alias("id")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("fraction", F.col("position").alias("p"))))).alias("fractions")
    )
    nothing = F.create_map().cast("map<string,string>")
    return d.join(st, "sitting_id").join(a, "agenda_item_id", "left").join(v, "roll_call_vote_id", "left").join(f, "id", "left").select(
        F.col("id").alias("decision_id"), "date", "kind", "n", "position", "top_id", "agenda_title", "subject", "drucksache_number", "result",
        F.coalesce("fractions", nothing).alias("fractions"), "roll_call_vote_id", F.col("totals").alias("roll_call"), "text",
        "source_url", "source_document_id", "pdf_url", "retrieved_at",
    ).orderBy("position")


#: What the register's wording means, and what of it is no decision (fixed values).
ADOPTED, REJECTED = "^(Annahme|Zustimmung)", "^(Ablehnung|Zurückweisung)"
NO_DECISION = "Überweis|Überwies|Wahlvorschl|Geschäftsordnung|Tagesordnung|Kenntnisnahme|Zurückverweis|erledigt"
ELECTIONS = "Besetzung interner Gremien des BT"
DECISIONS = "array<struct<abstimmungsart:string,dokumentnummer:string,beschlusstenor:string,seite:string>>"


def decision_check(t: Tables) -> DataFrame:
    """Q11: decisions whose result the register has otherwise, and the register's that no decision of the sitting covers.

    A decision covers one by a document number, by the procedure it is linked to, or by
    another document of that procedure; the three tests are anti joins.
    """
    st = t["sitting"].select(F.col("id").alias("sitting_id"), "date")
    said = F.when(F.col("dip_result").rlike(ADOPTED), "angenommen").when(F.col("dip_result").rlike(REJECTED), "abgelehnt")
    d = t["decision"]
    result = d.where(F.col("result").isNotNull() & ~F.col("subject").ilike("Beschlussempfehlung%") & (said != F.col("result"))).join(st, "sitting_id").select(
        F.lit("result").alias("kind"), "sitting_id", "date", F.col("id").alias("decision_id"), "subject", "drucksache_number", "result", "dip_result",
        "dip_position_id", "source_url", "source_document_id",
    )
    named = d.select("sitting_id", F.explode(document_numbers(F.col("drucksache_number"))).alias("number")).distinct()
    of_number = t["vorgang_drucksache"].join(t["drucksache"].select(F.col("id").alias("drucksache_id"), "number"), "drucksache_id").select("number", "vorgang_id")
    linked = (
        named.join(of_number, "number").select("sitting_id", "vorgang_id")
        .union(t["decision_vorgang"].join(d.select(F.col("id").alias("decision_id"), "sitting_id"), "decision_id").select("sitting_id", "vorgang_id"))
        .distinct()
    )
    elections = t["vorgang"].where(F.col("type") == ELECTIONS).select(F.col("id").alias("vorgang_id"))
    p = t["vorgang_position"].where("chamber = 'BT' AND document_kind = 'Plenarprotokoll'").join(elections, "vorgang_id", "left_anti")
    each = p.select(
        F.col("id").alias("dip_position_id"), "vorgang_id", F.col("document_number").alias("sitting_id"), "position", "source_url", "source_document_id",
        F.posexplode(F.from_json("decisions", DECISIONS)).alias("nth", "b"),
    ).join(st, "sitting_id")
    tenor = F.coalesce(F.col("b.beschlusstenor"), F.lit(""))
    open_ = each.where(
        ~F.contains(F.coalesce(F.col("b.abstimmungsart"), F.lit("")), F.lit("Wahl"))
        & (F.size(document_numbers(F.coalesce(F.col("b.dokumentnummer"), F.lit("")))) > 0)
        & ~tenor.rlike(NO_DECISION)
    )
    numbers = open_.select("dip_position_id", "nth", "sitting_id", F.explode(document_numbers(F.col("b.dokumentnummer"))).alias("number"))
    covered = numbers.join(named, ["sitting_id", "number"], "left_semi").select("dip_position_id", "nth").distinct()
    missing = open_.join(covered, ["dip_position_id", "nth"], "left_anti").join(linked, ["sitting_id", "vorgang_id"], "left_anti")
    titles = t["vorgang"].select(F.col("id").alias("vorgang_id"), "title")
    missing = missing.join(titles, "vorgang_id", "left").select(
        F.lit("missing").alias("kind"), "sitting_id", "date", "vorgang_id", "title", "position", tenor.alias("dip_result"),
        F.col("b.dokumentnummer").alias("drucksache_number"), F.col("b.seite").alias("page"), "dip_position_id", "source_url", "source_document_id",
    )
    return result.unionByName(missing, allowMissingColumns=True).orderBy("date", "sitting_id", "kind")


def protocol_gaps(t: Tables) -> DataFrame:
    """Q12: consultations that the register places in a sitting and no item of it carries, with a cause; preliminary sittings always."""
    items = t["agenda_item"].select(F.col("id").alias("agenda_item_id"), "sitting_id", "drucksache_numbers")
    of = items.select("agenda_item_id", "sitting_id")
    vorlagen = t["agenda_item_vorlage"].select("agenda_item_id", "drucksache_number", "vorgang_id").join(of, "agenda_item_id")
    numbers = (
        items.select("sitting_id", F.explode("drucksache_numbers").alias("number"))
        .union(t["agenda_sub_item"].select("agenda_item_id", F.explode("drucksache_numbers").alias("number")).join(of, "agenda_item_id").select("sitting_id", "number"))
        .union(vorlagen.select("sitting_id", F.col("drucksache_number").alias("number")))
        .distinct()
    )
    carried = vorlagen.where("vorgang_id IS NOT NULL").select("sitting_id", "vorgang_id").distinct()
    documents_of = (
        t["vorgang_drucksache"].join(t["drucksache"].select(F.col("id").alias("drucksache_id"), "number"), "drucksache_id").select("vorgang_id", "number")
        .union(t["vorgang_position"].where("document_kind = 'Drucksache' AND chamber = 'BT' AND document_number IS NOT NULL").select("vorgang_id", F.col("document_number").alias("number")))
        .distinct()
    )
    sittings = t["sitting"].withColumnRenamed("id", "sitting_id")
    p = t["vorgang_position"].where(
        (F.col("chamber") == "BT") & (F.col("document_kind") == "Plenarprotokoll") & F.col("pages").isNotNull()
        & F.col("position").ilike("%Beratung%") & ~F.col("position").ilike("Geschäftsordnungsantrag%")
    ).select(F.col("id").alias("vorgang_position_id"), "vorgang_id", F.col("document_number").alias("sitting_id"), "position", "pages", F.col("date").alias("on"))
    p = p.join(sittings.select("sitting_id", "preliminary", "last_page"), "sitting_id").join(carried, ["sitting_id", "vorgang_id"], "left_anti")
    met = p.select("vorgang_position_id", "sitting_id", "vorgang_id").join(documents_of, "vorgang_id").join(numbers, ["sitting_id", "number"], "left_semi")
    gaps = p.join(met.select("vorgang_position_id").distinct(), "vorgang_position_id", "left_anti").join(
        t["vorgang"].select(F.col("id").alias("vorgang_id"), "title"), "vorgang_id", "left"
    )
    no_end = F.coalesce(F.col("last_page"), F.lit(0)) == 0
    cause = (
        F.when(F.col("preliminary") & no_end, "preliminary")
        .when(F.col("preliminary") & (first_page(F.col("pages")) >= F.col("last_page")), "after_xml_end")
        .otherwise("in_protocol")
    )
    entry = F.struct("on", "pages", "vorgang_position_id", "vorgang_id", "title", "position", cause.alias("cause"))
    listed = gaps.groupBy("sitting_id").agg(F.sort_array(F.collect_list(entry)).alias("beratungen"))
    from_pdf = t["speech"].where(F.col("source_url").ilike("%.pdf")).groupBy("sitting_id").agg(F.count("*").alias("pdf_speeches"))
    out = sittings.join(listed, "sitting_id", "left").where("preliminary OR beratungen IS NOT NULL").join(from_pdf, "sitting_id", "left")
    return out.select(
        "sitting_id", "date", "preliminary", "final_announced", "first_page", "last_page", F.coalesce("pdf_speeches", F.lit(0)).alias("pdf_speeches"),
        F.coalesce("beratungen", F.array().cast(listed.schema["beratungen"].dataType)).alias("beratungen"),
        "pdf_url", "source_url", "source_document_id", "retrieved_at", "wahlperiode", "number",
    ).orderBy("wahlperiode", "number").drop("wahlperiode", "number")

