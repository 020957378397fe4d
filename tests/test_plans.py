import csv
import datetime
import gzip
import io
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.checks import orphans
from tessera.plans import export, health, queries, schemas, steps
from tessera.plans.store import Conflict, Store

D = datetime.date
P = {"source_url": "u", "source_document_id": "d", "retrieved_at": "t"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def make(spark, name, *records):
    """Rows of a table from dictionaries; what is not given is null, or provenance."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.TABLES[name].schema])
    return spark.createDataFrame([tuple((P | r).get(f.name) for f in schema) for r in records], schema)


class Tables(dict):
    """Tables of a test; those that it does not make are empty."""

    def __init__(self, spark, **made):
        super().__init__({n: schemas.empty(spark, n) for n in schemas.TABLES})
        self.update({n: make(spark, n, *r) for n, r in made.items()})


def test_registry():
    assert len(schemas.TABLES) == 40
    for t in schemas.TABLES.values():
        assert set(t.key) <= set(t.schema.names)
        for c, (parent, key) in t.references.items():
            assert c in t.schema.names and key in schemas.TABLES[parent].key
    assert "text" not in schemas.TABLES["hib_item"].public


def test_conform_and_violations(spark):
    df = spark.createDataFrame([("a", "1", 9), ("a", None, 9)], "party string, fraction string, extra int")
    made = schemas.conform(df, "party_fraction")
    assert made.columns == ["party", "fraction"]
    assert rows(schemas.violations({"party_fraction": made})) == [("party_fraction", "key", 1), ("party_fraction", "required", 1)]
    t = Tables(spark, mandate=[{"id": "1", "person_id": "x", "wahlperiode": 21, "from_date": D(2025, 1, 1)}])
    assert ("mandate", "reference person_id", 1) in rows(schemas.violations({"mandate": t["mandate"], "person": t["person"]}))


@pytest.fixture(scope="module")
def people(spark):
    p = [
        {"id": "1", "first_name": "Anna", "last_name": "Muster", "is_mdb": True, "birth_date": D(1970, 1, 1)},
        {"id": "2", "first_name": "Bernd Otto", "last_name": "Test", "is_mdb": True, "birth_date": D(1980, 1, 1)},
        {"id": "3", "first_name": "Eva", "last_name": "Doppel", "is_mdb": True, "birth_date": D(1971, 1, 1)},
        {"id": "4", "first_name": "Eva", "last_name": "Doppel", "is_mdb": True, "birth_date": D(1972, 1, 1)},
        {"id": "5", "first_name": "Gast", "last_name": "Redner", "is_mdb": False, "role": "Bundesminister der Finanzen"},
        {"id": "pdf-x", "first_name": "Gast", "last_name": "Redner", "is_mdb": False},
    ]
    m = [{"id": f"{k}/21", "person_id": str(k), "wahlperiode": 21, "from_date": D(2025, 3, 25)} for k in (1, 2, 3, 4)]
    b = [
        {"id": "b1", "person_id": "1", "wahlperiode": 21, "kind": "fraction", "name": "SPD", "from_date": D(2025, 3, 25), "to_date": D(2025, 6, 1)},
        {"id": "b2", "person_id": "1", "wahlperiode": 21, "kind": "fraction", "name": "Die Linke", "from_date": D(2025, 6, 2)},
        {"id": "b3", "person_id": "2", "wahlperiode": 21, "kind": "other", "name": "Bundesministerium der Finanzen", "role": "Parlamentarischer Staatssekretär", "from_date": D(2025, 5, 10)},
    ]
    return Tables(spark, person=p, mandate=m, membership=b)


def test_match_persons(spark, people):
    probes = [(1, "Muster", "Anna", None), (2, "von Test", "Bernd", None), (3, "Doppel", "Eva", None), (4, "Doppel (Ort)", "Eva", "1972"), (5, "Krampe", "Jan", None), (6, "Redner", "Gast", None), (7, "Neu Muster", "Anna", None)]
    df = spark.createDataFrame(probes, "n int, l string, f string, y string")
    got = {r["n"]: r["matched_id"] for r in steps.match_persons(df, "n", "l", "f", "y", people["person"], people["mandate"], 21).collect()}
    assert got == {1: "1", 2: "2", 3: None, 4: "4", 5: "11005511", 6: None, 7: "1"}
    voters = {r["n"]: r["matched_id"] for r in steps.match_persons(df, "n", "l", "f", "y", people["person"], people["mandate"], 21, voters=True).collect()}
    assert voters[6] == "5"


def test_match_elected(spark, people):
    c = spark.createDataFrame([(1, "Test", "Karl Bernd Otto", 1980), (2, "Muster-Neu", "Zoe", 1970), (3, "Doppel", "Xenia", 1999)], "position int, last_name string, first_names string, birth_year int")
    assert rows(steps.match_elected(c, people["person"], people["mandate"], 21)) == [(1, "2"), (2, "1"), (3, None)]


def test_resolve_person(people):
    assert queries.resolve_person(people, "muster") == "1" and queries.resolve_person(people, "Bernd Otto Test") == "2" and queries.resolve_person(people, "3") == "3"
    for who in ("Doppel", "Niemand"):
        with pytest.raises(queries.Unclear):
            queries.resolve_person(people, who)


@pytest.fixture(scope="module")
def store(spark, people):
    t = Tables(
        spark,
        sitting=[
            {"id": "21/5", "wahlperiode": 21, "number": 5, "date": D(2025, 4, 2), "preliminary": False},
            {"id": "21/10", "wahlperiode": 21, "number": 10, "date": D(2025, 7, 1), "preliminary": True, "last_page": 100},
        ],
        agenda_item=[
            {"id": "21/5/1", "sitting_id": "21/5", "position": 1, "top_id": "TOP 1", "title": "Debatte", "drucksache_numbers": ["21/7"]},
            {"id": "21/5/2", "sitting_id": "21/5", "position": 2, "top_id": "TOP 2", "title": "Fragestunde", "drucksache_numbers": []},
        ],
        speech=[
            {"id": "R1", "sitting_id": "21/5", "agenda_item_id": "21/5/1", "position": 1, "person_id": "1", "text": "eins zwei", "fraction": "SPD", "kind": "rede"},
            {"id": "R1-2", "sitting_id": "21/5", "agenda_item_id": "21/5/1", "position": 2, "person_id": "2", "text": "Frage", "fraction": "AfD", "kind": "rede"},
            {"id": "R2", "sitting_id": "21/5", "agenda_item_id": "21/5/1", "position": 3, "person_id": "5", "text": "Antwort", "kind": "rede", "source_url": "x.PDF"},
            {"id": "R3", "sitting_id": "21/10", "position": 1, "person_id": "1", "text": "", "fraction": "SPD", "kind": "rede"},
        ],
        roll_call_vote=[
            {"id": "21/5/1", "sitting_id": "21/5", "number": 1, "date": D(2025, 4, 2), "title": "zu 21/7", "drucksache_number": "21/7", "yes": 2, "no": 1, "abstain": 0, "invalid": 0, "absent": 1},
            {"id": "21/5/2", "sitting_id": "21/5", "number": 2, "date": D(2025, 4, 2), "title": "ohne", "yes": 0, "no": 0, "abstain": 0, "invalid": 0, "absent": 0},
        ],
        individual_vote=[
            {"id": f"v{k}", "vote_id": "21/5/1", "person_id": p, "fraction": f, "vote": v}
            for k, (p, f, v) in enumerate([("1", "SPD", "no"), ("2", "SPD", "yes"), ("3", "SPD", "yes"), (None, "AfD", "absent")])
        ],
        drucksache=[
            {"id": "d7", "number": "21/7", "type": "Antrag", "date": D(2025, 3, 1), "publisher": "BT", "originators": ["Fraktion der SPD", "Fraktion der SPD", "Innenausschuss"]},
            {"id": "d8", "number": "21/8", "type": "Unterrichtung", "date": D(2025, 3, 1), "publisher": "BT", "originators": []},
            {"id": "d9", "number": "21/9", "type": "Gesetzentwurf", "date": D(2025, 3, 2), "publisher": "BT", "originators": []},
        ],
        drucksache_author=[
            {"id": "a1", "drucksache_id": "d7", "dip_person_id": "x", "person_id": "1", "name": "A", "activity_type": "Antrag"},
            {"id": "a2", "drucksache_id": "d9", "dip_person_id": "x", "person_id": "1", "name": "A", "activity_type": "Berichterstattung"},
        ],
        vorgang=[{"id": "w1", "type": "Antrag", "title": "W1"}, {"id": "w2", "type": "Gesetzgebung", "title": "W2"}, {"id": "w3", "type": queries.ELECTIONS, "title": "W3"}],
        vorgang_drucksache=[{"vorgang_id": "w1", "drucksache_id": "d7"}, {"vorgang_id": "w1", "drucksache_id": "d8"}, {"vorgang_id": "w2", "drucksache_id": "d8"}, {"vorgang_id": "w2", "drucksache_id": "d9"}],
        vorgang_position=[
            {"id": "p1", "vorgang_id": "w1", "date": D(2025, 4, 2), "position": "Beratung", "chamber": "BT", "document_kind": "Plenarprotokoll", "document_number": "21/5", "pages": "10-12",
             "decisions": json.dumps([{"beschlusstenor": "Ablehnung der Vorlage", "dokumentnummer": "21/7", "seite": "11"}])},
            {"id": "p2", "vorgang_id": "w2", "date": D(2025, 4, 2), "position": "1. Beratung", "chamber": "BT", "document_kind": "Plenarprotokoll", "document_number": "21/5", "pages": "14",
             "decisions": json.dumps([{"beschlusstenor": "Annahme", "dokumentnummer": "21/9"}, {"beschlusstenor": "Überweisung", "dokumentnummer": "21/9"}])},
            {"id": "p3", "vorgang_id": "w2", "date": D(2025, 7, 1), "position": "2. Beratung", "chamber": "BT", "document_kind": "Plenarprotokoll", "document_number": "21/10", "pages": "120"},
            {"id": "p4", "vorgang_id": "w3", "date": D(2025, 4, 2), "position": "Wahl", "chamber": "BT", "document_kind": "Plenarprotokoll", "document_number": "21/5",
             "decisions": json.dumps([{"beschlusstenor": "Annahme", "dokumentnummer": "21/9"}])},
        ],
        decision=[
            {"id": "21/5/p4", "sitting_id": "21/5", "agenda_item_id": "21/5/1", "n": 1, "position": 1, "kind": "handzeichen", "subject": "Antrag", "drucksache_number": "21/7", "result": "angenommen", "dip_result": "Ablehnung der Vorlage"},
            {"id": "21/5/1", "sitting_id": "21/5", "agenda_item_id": "21/5/1", "n": 1, "position": 2, "kind": "namentlich", "subject": "Antrag", "roll_call_vote_id": "21/5/1"},
        ],
        decision_fraction=[{"decision_id": "21/5/p4", "fraction": "SPD", "position": "yes"}, {"decision_id": "21/5/p4", "fraction": "AfD", "position": "no"}],
        person_photo=[{"person_id": "1", "image_url": "i", "local_path": "l"}],
        government_role=[
            {"id": "g1", "person_id": "5", "name": "G", "office": "Bundesminister der Finanzen", "department": "Bundesministerium der Finanzen", "kind": "minister", "from_date": D(2025, 1, 1), "to_date": D(2025, 2, 1), "source_kind": "protocol"},
            {"id": "g2", "person_id": "1", "name": "A", "office": "Staatsminister", "kind": "staatsminister", "from_date": D(2025, 1, 1), "to_date": D(2025, 3, 1), "source_kind": "wikidata"},
        ],
    )
    t.update({n: people[n] for n in ("person", "mandate", "membership")})
    return t


def test_speeches_and_corpus(store):
    assert [r["speech_id"] for r in queries.speeches(store, "1", "2025-01-01", "2025-12-31").collect()] == ["R1", "R3"]
    assert [r["speech_id"] for r in queries.corpus(store, "2025-01-01", "2025-12-31").collect()] == ["R1", "R1-2", "R2"]


def test_votes(store):
    a, b = queries.votes(store, "1", "2025-01-01", "2025-12-31").collect()
    assert a["own_vote"] == "no" and a["fraction_line"]["majority"] == "yes" and a["fraction_line"]["counts"] == {"yes": 2, "no": 1} and a["result"]["yes"] == 2
    assert b["own_vote"] is None and b["fraction_line"] is None


def test_documents_and_photos(store):
    assert [r["number"] for r in queries.documents(store, "1", "2025-01-01", "2025-12-31").collect()] == ["21/7"]
    assert [r["person_id"] for r in queries.photos(store).collect()] == ["1"]
    assert [(r["person_id"], r["fraction"]) for r in queries.photos_missing(store).collect()] == [("3", None), ("4", None), ("2", None)]


def test_government(store):
    assert [r["id"] for r in queries.government(store).collect()] == ["g1", "g2"]
    assert [r["id"] for r in queries.government(store, "2025-05-01").collect()] == ["g1"]
    stale = queries.stale_roles(store).collect()
    assert [(r["id"], r["days_since_seen"], r["newest_sitting"]) for r in stale] == [("g1", 150, D(2025, 7, 1))]


def test_decision_queries(store):
    d = queries.decisions(store, "21/5").collect()
    assert [(r["decision_id"], r["fractions"], r["roll_call"] and r["roll_call"]["yes"]) for r in d] == [("21/5/p4", {"SPD": "yes", "AfD": "no"}, None), ("21/5/1", {}, 2)]
    assert [(r["kind"], r["decision_id"] or r["dip_position_id"]) for r in queries.decision_check(store).collect()] == [("missing", "p2"), ("result", "21/5/p4")]


def test_protocol_gaps(store):
    got = [(r["sitting_id"], [(b["vorgang_id"], b["cause"]) for b in r["beratungen"]], r["pdf_speeches"]) for r in queries.protocol_gaps(store).collect()]
    assert got == [("21/5", [("w2", "in_protocol")], 1), ("21/10", [("w2", "after_xml_end")], 0)]


def test_health(spark, store):
    n = {r["problem"]: r["n"] for r in health.problems(store).collect()}
    assert len(n) == 16
    assert n["protocol_gaps"] == 2 and n["decision_results_disputed"] == 1 and n["unmatched_votes"] == 1 and n["unlinked_roll_calls"] == 2 and n["stale_roles"] == 1 and n["placeholder_speakers"] == 1
    s = lambda x: spark.createDataFrame(x, "kind string, name string, n long")
    before = s([("table", "speech", 100), ("table", "gone", 5), ("problem", "unmatched_votes", 5), ("problem", "stale_roles", 0)])
    now = s([("table", "speech", 90), ("problem", "unmatched_votes", 106), ("problem", "stale_roles", 900), ("problem", "unmatched_elected", 50)])
    assert sorted(health.compare(before, now).failures()) == ["gone", "speech", "unmatched_votes"]
    days = spark.createDataFrame([("2025-01-01", 1), ("2025-01-08", 2), ("2025-01-15", 3)], "day string, n int").withColumn("day", F.to_date("day"))
    assert [r["n"] for r in health.latest_before(days, "2025-01-15").collect()] == [2]


def test_steps_on_documents(store):
    assert rows(steps.procedures_of_numbers(store)) == [("21/7", "w1"), ("21/9", "w2")]
    v = steps.item_documents(store).select("id", "vorgang_id", "via")
    assert rows(v) == [("21/5/1/21/7", "w1", "title")]
    t = dict(store) | {"agenda_item_vorlage": schemas.conform(steps.item_documents(store), "agenda_item_vorlage")}
    links = steps.decision_procedures(t)
    assert rows(links) == [("21/5/1", "w1", "drucksache"), ("21/5/p4", "w1", "dip_step")]
    d = {r["id"]: (r["vorgang_id"], r["dip_position_id"], r["dip_result"]) for r in steps.decided_columns(t, links).collect()}
    assert d == {"21/5/p4": ("w1", "p1", "Ablehnung der Vorlage"), "21/5/1": ("w1", None, None)}
    assert {r["id"]: r["agenda_item_id"] for r in steps.votes_to_items(store).collect()} == {"21/5/1": "21/5/1", "21/5/2": None}
    assert {r["id"]: r["originator_groups"] for r in steps.document_groups(store["drucksache"]).collect()}["d7"] == ["SPD"]


def test_groups(store):
    s = {r["id"]: (r["speaker_group"], r["member_fraction"]) for r in steps.speech_groups(store).collect()}
    assert s == {"R1": ("SPD", "SPD"), "R1-2": ("AfD", "AfD"), "R2": ("Bundesregierung", None), "R3": ("SPD", "Die Linke")}
    p = {r["id"]: r["fraction"] for r in steps.person_groups(store).collect()}
    assert p["1"] == "Die Linke" and p["3"] == "SPD" and p["4"] == "fraktionslos" and p["5"] is None


def test_speech_parts(store):
    got = {r["id"]: (r["rede_id"], r["interruption"], r["interruption_start"]) for r in steps.speech_parts(store).collect()}
    assert got["R1"] == ("R1", None, None) and got["R1-2"] == ("R1", "zwischenfrage", "R1-2") and got["R2"] == ("R2", None, None)
    assert {r["id"]: r["kind"] for r in steps.item_kinds(store).collect()} == {"21/5/1": None, "21/5/2": "fragestunde"}


def test_offices(spark, store):
    spoken = steps.spoken_offices(store, "2025-01-01")
    assert rows(spoken.select("person_id", "kind", "department", "from_date", "to_date")) == [("5", "minister", "Bundesministerium der Finanzen", D(2025, 4, 2), D(2025, 4, 2))]
    members = steps.membership_offices(store, "2025-01-01")
    assert rows(members.select("person_id", "kind", "department")) == [("2", "parl_sts", "Bundesministerium der Finanzen")]
    wiki = spark.createDataFrame([("wikidata", "9", "W", "minister", "Bundesministerium der Finanzen", D(2025, 1, 1), None, "Q9", "u", "d", "t", "S1", "Finanzminister")],
        "source_kind string, person_id string, name string, kind string, department string, from_date date, to_date date, wikidata_qid string, source_url string, source_document_id string, retrieved_at string, id string, office string")
    r = {x["person_id"]: x for x in steps.government_roles(wiki.unionByName(members, allowMissingColumns=True).unionByName(spoken, allowMissingColumns=True)).collect()}
    assert r["9"]["to_date"] == D(2025, 4, 1) and r["9"]["id"] == "S1" and r["9"]["office"] == "Finanzminister"
    assert r["2"]["id"] == "stammdaten:2:parl_sts:bundesministerium-der-finanzen" and r["2"]["office"] == "Parlamentarischer Staatssekretär beim Bundesminister der Finanzen"
    assert r["5"]["to_date"] == D(2025, 4, 2)


def test_retired_placeholders(spark, store):
    assert rows(steps.retired(store["person"], store).select("id")) == [("pdf-x",)]
    t = dict(store) | {"interjection": make(spark, "interjection", {"id": "i", "speech_id": "R1", "person_id": "pdf-x"})}
    assert rows(steps.retired(store["person"], t).select("id")) == []


def test_sub_items(spark):
    p = [(1, "chair", "", "Es handelt sich um Vorlagen, zu denen keine Aussprache vorgesehen ist."), (2, "chair", "", "Tagesordnungspunkt 41b:"), (3, "procedural", "T_fett", "Titel b"), (4, "procedural", "T_Drs", "Drucksache 21/3"), (5, "chair", "", "Zusatzpunkt 8:"), (6, "chair", "", "Tagesordnungspunkt 41b:")]
    df = spark.createDataFrame([("i", *x) for x in p] + [("j", *p[1])], "agenda_item_id string, position int, kind string, class string, text string")
    got = rows(steps.sub_items(df).select("id", "position", "title", "drucksache_numbers", "no_debate", "first_paragraph", "last_paragraph"))
    assert got == [("i/41b", 1, "Titel b", ["21/3"], True, 2, 4), ("i/ZP8", 2, None, [], True, 5, 6)]


def test_decisions_of_a_sitting(spark, store):
    text = "Wir kommen zur Abstimmung über den Antrag auf Drucksache 21/7. Wer stimmt dafür? – Die SPD. Wer stimmt dagegen? – Die AfD. Der Antrag ist angenommen."
    chair = spark.createDataFrame([("21/5", "21/5/1", 4, 2, text)], "sitting_id string, agenda_item_id string, paragraph int, at int, text string")
    (d,) = steps.decisions(chair, store["roll_call_vote"], 21).collect()
    assert (d["id"], d["kind"], d["result"], d["drucksache_number"], d["fractions"]) == ("21/5/p4", "handzeichen", "angenommen", "21/7", {"SPD": "yes", "AfD": "no"})
    subs = make(spark, "agenda_sub_item", {"id": "s", "agenda_item_id": "21/5/1", "first_paragraph": 1, "drucksache_numbers": ["21/99"]})
    (placed,) = steps.decisions_in_sub_items(steps.decisions(chair, store["roll_call_vote"], 21).withColumn("sub_item_id", F.lit(None)), subs).collect()
    assert placed["sub_item_id"] == "s" and placed["drucksache_number"] == "21/7"


def test_decisions_across_sittings(spark):
    said = [
        ("21/9", "21/9/1", 1, 1, "Ich eröffne die namentliche Abstimmung über den Antrag auf Drucksache 21/3."),
        ("21/10", "21/10/1", 1, 1, "Das Ergebnis der namentlichen Abstimmung von gestern: Mit Ja haben gestimmt 20, mit Nein haben gestimmt 30. Der Antrag auf Drucksache 21/3 ist abgelehnt."),
        ("21/10", "21/10/1", 2, 2, "Zusatzpunkt 4. Wer stimmt für den Antrag auf Drucksache 21/5? – Die SPD. Der Antrag ist angenommen."),
        ("21/10", "21/10/2", 3, 1, "Ich rufe auf."),
    ]
    chair = spark.createDataFrame(said, "sitting_id string, agenda_item_id string, paragraph int, at int, text string")
    items = make(spark, "agenda_item", *({"id": i, "top_id": t, "drucksache_numbers": d} for i, t, d in (("21/10/1", "Tagesordnungspunkt 1", []), ("21/10/2", "Zusatzpunkt 4", ["21/5"]))))
    votes = make(spark, "roll_call_vote", {"id": "v", "sitting_id": "21/9", "number": 1, "yes": 20, "no": 31})
    found = steps.decisions(chair, votes, 21, items).orderBy("sitting_id").collect()
    assert [(r["sitting_id"], r["agenda_item_id"], r["kind"], r["result"], r["roll_call_vote_id"]) for r in found] == [
        ("21/10", "21/10/2", "handzeichen", "angenommen", None), ("21/9", "21/9/1", "namentlich", "abgelehnt", "v"),
    ]


def test_call_ups(spark):
    texts = ["Tagesordnungspunkt 8", "Ich rufe jetzt auf den Zusatzpunkt 9 a:", "TOP 7b", "Wir kommen zum Tagesordnungspunkt 8 und der Debatte", "Tagesordnungspunkt 8.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(steps.call_up(F.col("t"))).collect()] == ["8", "ZP9a", "7b", None, None, None]
    texts = ["Eine Aussprache ist nicht vorgesehen.", "Wir stimmen ohne Debatte ab. Danke.", "Zur ersten Beratung ist keine Aussprache geplant.", "Die Aussprache beginnt."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(steps.no_debate(F.col("t"))).collect()] == [True, True, False, False]


def test_records(spark):
    r = [("1", "v", "2025-01-01", "Beratung", "BT", {"anfangsseite": 10, "endseite": 12}, [{"ausschuss": "A", "federfuehrung": False}, {"ausschuss": "A", "federfuehrung": True}], "2025-02-01", "f1"), ("1", "v", "2025-01-01", "Alt", "BT", None, None, "2025-01-01", "f2")]
    schema = ("id string, vorgang_id string, datum string, vorgangsposition string, zuordnung string, fundstelle struct<dokumentart:string,dokumentnummer:string,drucksachetyp:string,pdf_url:string,anfangsseite:int,endseite:int>, "
              "ueberweisung array<struct<ausschuss:string,ausschuss_kuerzel:string,federfuehrung:boolean,ueberweisungsart:string>>, retrieved_at string, path string")  # fmt: skip
    df = spark.createDataFrame([tuple(x) for x in r], schema).withColumns({"dokumentart": F.lit("Drucksache"), "urheber": F.from_json(F.lit("[]"), "array<struct<titel:string>>"), "ressort": F.from_json(F.lit("[]"), "array<struct<titel:string>>"), "beschlussfassung": F.from_json(F.lit("[]"), "array<struct<abstimmungsart:string>>")})
    (x,) = steps.procedure_steps(df).collect()
    assert (x["position"], x["pages"], x["document_kind"], x["decisions"]) == ("Beratung", "10-12", "Drucksache", None)
    assert rows(steps.referrals(df.where("retrieved_at = '2025-02-01'")).select("committee", "lead")) == [("A", True)]


def test_question_status(spark):
    t = Tables(
        spark,
        vorgang=[{"id": "k1", "type": "Kleine Anfrage"}, {"id": "k2", "type": "Kleine Anfrage"}, {"id": "k3", "type": "Kleine Anfrage"}, {"id": "s1", "type": "Schriftliche Frage"}, {"id": "s2", "type": "Schriftliche Frage"}],
        drucksache=[{"id": "x9", "number": "21/9", "type": "Antwort", "originators": []}, {"id": "x10", "number": "21/10", "type": "Antwort", "originators": []}],
        vorgang_drucksache=[{"vorgang_id": "k1", "drucksache_id": "x9"}, {"vorgang_id": "k1", "drucksache_id": "x10"}, {"vorgang_id": "k2", "drucksache_id": "x9"}],
        question_text=[
            {"id": "1", "part": "frage", "number": "1", "source_document_id": "BT-Drs. 21/10"}, {"id": "2", "part": "frage", "number": "2", "source_document_id": "BT-Drs. 21/10"},
            {"id": "3", "part": "antwort", "number": "1", "source_document_id": "BT-Drs. 21/10"}, {"id": "4", "part": "frage", "number": "7", "vorgang_id": "s1", "source_document_id": "BT-Drs. 21/11"},
        ],
    )
    got = {r["vorgang_id"]: (r["status"], r["questions"], r["answered"]) for r in steps.question_status(t).collect()}
    assert got == {"k1": ("partial", 2, 1), "k2": ("failed", 0, 0), "k3": ("unanswered", 0, 0), "s1": ("unanswered", 1, 0), "s2": ("failed", 0, 0)}


def test_export_is_deterministic_and_atomic(spark, store, tmp_path):
    t = {n: store[n] for n in ("sitting", "person_photo", "hib_item")}
    a = export.write_export(t, tmp_path / "out", "Titel", "2025-01-01")
    first = (tmp_path / "out/sitting.csv.gz").read_bytes()
    export.write_export(t, tmp_path / "out", "Titel", "2025-01-01")
    assert (tmp_path / "out/sitting.csv.gz").read_bytes() == first and {x["name"]: x["rows"] for x in a}["sitting.csv.gz"] == 2
    lines = gzip.decompress(first).decode().splitlines()
    assert lines[0].startswith("id,wahlperiode,number,date") and [x.split(",")[0] for x in lines[1:]] == ["21/10", "21/5"] and ",1," in lines[1]
    package = json.loads((tmp_path / "out/datapackage.json").read_text())
    fields = {r["name"]: [f["name"] for f in r["schema"]["fields"]] for r in package["resources"]}
    assert "local_path" not in fields["person_photo"] and "text" not in fields["hib_item"] and package["latest_sitting_date"] == "2025-07-01"
    with pytest.raises(KeyError):
        export.write_export({"nope": store["sitting"]}, tmp_path / "out", "x", "y")
    assert (tmp_path / "out/sitting.csv.gz").read_bytes() == first and not list(tmp_path.glob(".out*"))


def test_store_keeps_versions(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    assert s.table("party_fraction").count() == 0
    for k in range(3):
        held = s.table("party_fraction")
        s.write({"party_fraction": spark.createDataFrame([(f"p{k}", "f")], "party string, fraction string")})
        assert held.count() == (k > 0)  # a reader's version stays while the next is written
    assert rows(s.table("party_fraction")) == [("p2", "f")] and len(list((tmp_path / "store/party_fraction").iterdir())) == 2
    assert set(s.tables()) == set(schemas.TABLES)


def test_export_in_members(spark, tmp_path):
    """The file is the same however the rows are cut into partitions, and reads as one gzip file."""
    rows_ = [(f"k{k:04d}", None if k % 7 == 0 else f'a "b", {k}\nc') for k in range(1000)]
    df = spark.createDataFrame(rows_, "id string, text string")
    for k, made in enumerate((df.repartition(1), df.repartition(7), df.repartition(3))):
        n, digest = export.write_csv(made.orderBy("id"), ["id", "text"], tmp_path / f"{k}.gz", rows=64)
        assert n == 1000 and len(digest) == 64
    a, b, c = ((tmp_path / f"{k}.gz").read_bytes() for k in range(3))
    assert a == b == c
    read = list(csv.reader(io.StringIO(gzip.decompress(a).decode(), newline="")))
    assert read == [["id", "text"], *([i, t or ""] for i, t in rows_)]
    assert export.write_csv(df.where("false").orderBy("id"), ["id", "text"], tmp_path / "none.gz")[0] == 0
    assert gzip.decompress((tmp_path / "none.gz").read_bytes()) == b"id,text\n"


def test_two_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/store"
    Store(spark, root).write({"party_fraction": spark.createDataFrame([("p", "f")], "party string, fraction string")})
    make = {
        "party_fraction": lambda k: spark.createDataFrame([(f"p{k}", "f")], "party string, fraction string"),
        "hib_drucksache": lambda k: spark.createDataFrame([(f"h{k}", f"21/{k}", 1)], "hib_id string, drucksache_number string, position int"),
    }

    def writer(name):
        return [Store(spark, root).write({name: make[name](k)}, keep=50) for k in range(5)]

    with ThreadPoolExecutor(2) as pool:
        numbers = list(pool.map(writer, make))
    assert sorted(n for each in numbers for n in each) == list(range(2, 12)) == Store(spark, root).versions()[1:]
    s = Store(spark, root)
    assert s.table("party_fraction").head()["party"] == "p4" and s.table("hib_drucksache").head()["drucksache_number"] == "21/4"
    assert s.tables(1)["hib_drucksache"].count() == 0 and s.tables(1)["party_fraction"].head()["party"] == "p"
    assert all(a < b for each in numbers for a, b in zip(each, each[1:], strict=False))


def test_a_conflict_leaves_the_other_writers_version(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    one = lambda x: {"party_fraction": spark.createDataFrame([(x, "f")], "party string, fraction string")}
    read = s.write(one("a"))
    s.write(one("b"))
    with pytest.raises(Conflict):
        s.write(one("c"), read=read)
    assert s.table("party_fraction").head()["party"] == "b" and len(list((tmp_path / "store/party_fraction").iterdir())) == 2
    assert s.write(one("d"), read=s.image()[0]) == 3


def test_orphans(spark, store):
    assert orphans(store["speech"], "person_id", store["person"], "id").count() == 0


def test_stream_upserts(spark, tmp_path):
    from tessera.streaming import incremental

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("at", T.TimestampType())])
    src, box = tmp_path / "in", {"image": spark.createDataFrame([], "id int, v string, at timestamp")}
    at = lambda d: datetime.datetime(2025, 1, d)
    stream = lambda: incremental.file_stream(spark, str(src), schema)
    spark.createDataFrame([(1, "a", at(1)), (1, "b", at(2)), (2, "c", at(1))], schema).write.mode("append").parquet(str(src))

    def write(df):
        box["image"] = spark.createDataFrame(df.collect(), schema)

    for _ in range(2):
        q = incremental.upsert_stream(stream(), lambda: box["image"], write, ["id"], [F.col("at").desc()], str(tmp_path / "check"))
        q.processAllAvailable()
        q.stop()
        spark.createDataFrame([(2, "d", at(3)), (3, "e", at(3))], schema).write.mode("append").parquet(str(src))
    assert rows(box["image"].select("id", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    counted = incremental.windowed_counts(stream(), "at", "1 day", [], "14 days")
    q = counted.writeStream.format("memory").queryName("windows").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sum(r["n"] for r in spark.table("windows").collect()) == 7
    q = incremental.first_copies(stream(), ["id"], "at").writeStream.format("memory").queryName("firsts").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("firsts").count() == 3
    q = incremental.sessions(stream(), "at", "36 hours", ["id"], "14 days").writeStream.format("memory").queryName("sessions").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    # Id 1 on two days in a row, id 2 two days apart, id 3 once.
    assert spark.table("sessions").count() == 4
