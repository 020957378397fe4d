import datetime
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import bronze, elections, fetch, protocol, registers, web

D = datetime.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts(spark, *contents):
    return spark.createDataFrame([(f"f{k}", c) for k, c in enumerate(contents)], "path string, content string")


def blobs(spark, *contents):
    return spark.createDataFrame([(f"f{k}", bytearray(c)) for k, c in enumerate(contents)], "path string, content binary")


def test_files_and_sidecars(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1"}, {"id": "2"}]))
    (tmp_path / "a.json.meta.json").write_text(json.dumps({"url": "u", "retrieved_at": "2025-01-01"}))
    (tmp_path / "b.json").write_text(json.dumps({"id": "2"}))
    (tmp_path / "b.json.meta.json").write_text(json.dumps({"url": "v", "retrieved_at": "2025-02-01"}))
    files = bronze.with_provenance(bronze.data_files(spark, str(tmp_path), "*.json"), bronze.sidecars(spark, str(tmp_path)))
    records = bronze.json_records(bronze.text(files), T.StructType([T.StructField("id", T.StringType())]))
    assert rows(bronze.latest_records(records, ["id"]).select("id", "source_url")) == [("1", "u"), ("2", "v")]
    done = files.select("path", "length", "modified", F.lit(1).alias("parser_version")).where(F.endswith("path", F.lit("a.json")))
    assert bronze.unparsed(files, done, 1).count() == 1 and bronze.unparsed(files, done, 2).count() == 2


RESULTS = """﻿Bund
Stand:;12.03.2025
;
Wahlart;Gebietsart;Gebietsnummer;Gebietsname;UegGebietsnummer;Gruppenart;Gruppenname;Gruppenreihenfolge;Stimme;Anzahl;Prozent;Gewählt
BT;Wahlkreis;1;Nord;1;System-Gruppe;Wahlberechtigte;1;;1000;;AAA
BT;Wahlkreis;1;Nord;1;System-Gruppe;Wählende;2;;800;80,0;AAA
BT;Wahlkreis;1;Nord;1;Partei;AAA;3;1;500;62,5;AAA
BT;Wahlkreis;1;Nord;1;Partei;BBB;4;1;;;AAA
BT;Wahlkreis;2;Süd;9;Einzelbewerber/Wählergruppe;Xaver;5;1;7;0,1;–
BT;Land;1;Land;;Partei;AAA;3;2;9;1,0;
;;;;
"""


def test_election_tables(spark):
    f = texts(spark, RESULTS).withColumn("content", F.regexp_replace("content", "^﻿", ""))
    assert rows(elections.constituencies(f).drop("path")) == [(D(2025, 3, 12), 1, "Nord", "SH", "AAA", 1000, 800), (D(2025, 3, 12), 2, "Süd", "BY", None, None, None)]
    assert rows(elections.constituency_results(f).select("constituency_number", "group_kind", "party", "vote", "votes", "percent")) == [(1, "party", "AAA", 1, 500, 62.5), (2, "individual", "Xaver", 1, 7, 0.1)]


def test_elected(spark):
    head = "Wahlart;Nachname;Vornamen;Titel;Namenszusatz;Geschlecht;Geburtjahr;Geburtsort;Beruf;Gruppenname;Kennzeichen;Gebietsnummer;GebietLandAbk;Listenplatz;Prozent;VerknKennzeichen;VerknGebietsnummer;VerknGebietLandAbk;VerknListenplatz"
    a = "BT;A;Anna;Dr.;;w;1970;X;Y;AAA;Kreiswahlvorschlag;7;;;40,5;Landesliste;;NW;2"
    b = "BT;B;Bert;;;m;1980;X;Y;AAA;Landesliste;;BY;5;;Kreiswahlvorschlag;9;;"
    got = elections.elected(texts(spark, f"Stand:;01.02.2025\n{head}\n{a}\n{b}"))
    assert rows(got.select("last_name", "elected_via", "constituency_number", "first_vote_percent", "list_state", "list_position")) == [
        ("A", "constituency", 7, 40.5, "NW", 2), ("B", "list", 9, None, "BY", 5),
    ]


def test_municipalities(spark):
    t = "# Gebietsstand: 30.11.2024\nWahlkreis-Nr;Wahlkreis-von;Wahlkreis-bis;RGS_Land;RGS_RegBez;RGS_Kreis;RGS_Gemeinde;Gemeindename;Kreisname\n1;;;01;0;02;003; Dorf ;Kreis\n2;1;2;01;0;02;004;Stadt;Kreis"
    got = elections.municipalities(texts(spark, t)).select("as_of", "ags", "name", "state", "constituency_number", "split")
    assert rows(got) == [(D(2024, 11, 30), "01002003", "Dorf", "SH", 1, False), (D(2024, 11, 30), "01002004", "Stadt", "SH", 2, True)]


def test_successions_and_rejects(spark):
    lines = spark.createDataFrame([("p", x) for x in ("1 Muster, Anna 1970 Lehrerin SPD, NRW, LL 012 Verzicht Test, Bernd 1980 Jurist CDU, BY, WK 013 01.04.2025", "2 unklar 01.04.2025", "Kopfzeile")], "path string, text string")
    assert rows(elections.successors(lines).select("number", "predecessor_name", "predecessor_state", "reason", "name", "seat", "from_date")) == [
        (1, "Muster, Anna", "NW", "Verzicht", "Test, Bernd", "WK 013", D(2025, 4, 1)), (None,) * 7,
    ]


def sheet(table):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = list(dict.fromkeys(c for r in table for c in r if isinstance(c, str)))
    cell = lambda r, k, v: f'<c r="{chr(65 + k)}{r}" t="s"><v>{strings.index(v)}</v></c>' if isinstance(v, str) else f'<c r="{chr(65 + k)}{r}"><v>{v}</v></c>'
    body = "".join(f"<row>{''.join(cell(n, k, v) for k, v in enumerate(r) if v is not None)}</row>" for n, r in enumerate(table, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(f'<si><t>{s}</t></si>' for s in strings)}</sst>")
    return out.getvalue()


def test_roll_call_sheet(spark):
    head = ["Wahlperiode", "Sitzungnr", "Abstimmnr", "Fraktion/Gruppe", "Name", "Vorname", "ja", "nein", "Enthaltung", "ungültig", "nichtabgegeben"]
    t = [head, [21, 3, 1, "SPD", "Muster", "Anna", 1, 0, 0, 0, 0], [21, 3, 1, "BÜ90/GR", "Test", None, 0, 0, 0, 0, 1], [21, 3, 1, "SPD", None, None, 0, 0, 0, 0, 0]]
    votes = registers.individual_votes(blobs(spark, sheet(t)))
    assert rows(votes.select("last_name", "first_name", "fraction", "vote")) == [("Muster", "Anna", "SPD", "yes"), ("Test", "", "BÜNDNIS 90/DIE GRÜNEN", "absent")]
    assert rows(registers.roll_calls(votes)) == [(21, 3, 1, 1, 0, 0, 0, 1)]


def test_master_data(spark, tmp_path):
    p = tmp_path / "m.xml"
    p.write_text(
        "<DOCUMENT><MDB><ID>11</ID><NAMEN><NAME><NACHNAME>Alt</NACHNAME><VORNAME>A</VORNAME><HISTORIE_BIS>01.01.2000</HISTORIE_BIS></NAME>"
        "<NAME><NACHNAME>Neu</NACHNAME><VORNAME>A</VORNAME><ADEL>Graf</ADEL><PRAEFIX>von</PRAEFIX></NAME></NAMEN>"
        "<BIOGRAFISCHE_ANGABEN><GEBURTSDATUM>02.03.1970</GEBURTSDATUM></BIOGRAFISCHE_ANGABEN><WAHLPERIODEN><WAHLPERIODE><WP>21</WP><MDBWP_VON>25.03.2025</MDBWP_VON>"
        "<INSTITUTIONEN><INSTITUTION><INSART_LANG>Fraktion/Gruppe</INSART_LANG><INS_LANG>Fraktion Die Linke</INS_LANG></INSTITUTION></INSTITUTIONEN></WAHLPERIODE></WAHLPERIODEN></MDB></DOCUMENT>"
    )
    raw = registers.members(spark, str(p))
    assert rows(registers.persons(raw).select("id", "last_name", "name_prefix", "birth_date")) == [("11", "Neu", "Graf von", D(1970, 3, 2))]
    assert rows(registers.mandates(raw).select("id", "from_date", "to_date")) == [("11/21", D(2025, 3, 25), None)]
    assert rows(registers.memberships(raw).select("id", "kind", "name")) == [("11/21/1", "fraction", "Die Linke")]


def test_statements_are_folded(spark):
    v = lambda **k: {a: {"value": b} for a, b in k.items()}
    base = dict(st="x/S1", person="x/Q1", personLabel="Eva Test", pos="x/Q2", posLabel="Bundesministerin", start="2025-05-06T00:00:00Z")
    b = [v(**base, **{"class": "x/Q248352"}, partyShort="SPD", image="x/a%20b.jpg"), v(**base, **{"class": "x/Q248352"}, partyShort="CDU")]
    got = registers.office_statements(texts(spark, json.dumps({"results": {"bindings": b}})))
    assert rows(got.select("id", "wikidata_qid", "party", "image", "kind", "from_date", "to_date")) == [("S1", "Q1", None, "File:a b.jpg", "minister", D(2025, 5, 6), None)]


def test_article_and_list(spark):
    page = (
        '<span class="bt-date"> 02.03.2026 </span><span class="bt-dachzeile">Inneres — Antwort — hib 7/2026</span><h1 class="bt-artikel__title">Ein &amp; Titel</h1>'
        '<div class="bt-artikel__article"> <div class="bt-standard-content"><p>Berlin: (hib/AB) Text <a href="https://dserver.bundestag.de/btd/21/012/2101234.pdf">(21/1234)</a> .</p><p>Zwei</p></div></div>'
    )
    got = web.articles(spark.createDataFrame([("1", page), ("2", "<p>nichts</p>")], "id string, content string"))
    assert rows(got.select("id", "number", "date", "title", "ressort", "kind", "author_code", "text")) == [("1", "7/2026", D(2026, 3, 2), "Ein & Titel", "Inneres", "Antwort", "AB", "Text (21/1234).\n\nZwei")]
    assert got.first()["drucksachen"] == ["21/1234"]
    lists = texts(spark, '<h3> 2. März 2026 </h3><a href="/x/kurzmeldungen-11"></a><a href="/x/kurzmeldungen-11"></a><h3>1. März 2026</h3><a href="y-kurzmeldungen-9"></a>')
    assert rows(web.list_items(lists).select("id", "date")) == [("11", D(2026, 3, 2)), ("9", D(2026, 3, 1))]


@pytest.mark.parametrize("text, want", [("Der Innenausschuss hat", "Innenausschuss"), ("Der Unterausschuss und der Ausschuss für Digitales und Staatsmodernisierung tagte", "Ausschuss für Digitales und Staatsmodernisierung"), ("Der Auswärtige Ausschuss und der Innenausschuss", "Auswärtiger Ausschuss"), ("Nichts", None)])
def test_committee(spark, text, want):
    official = ["Ausschuss für Digitales", "Ausschuss für Digitales und Staatsmodernisierung"]
    df = spark.createDataFrame([(text, "Anderes")], "t string, r string")
    assert df.select(web.committee(F.col("t"), F.col("r"), official)).first()[0] == want


@pytest.mark.parametrize("printed, want", [("Schneider (Erfurt), Carsten", ("Schneider", "Carsten")), ("Aken, Jan van", ("van Aken", "Jan")), ("Test, Dr. Eva", ("Test", "Eva")), ("Graf, Van", ("Graf", "Van"))])
def test_card_names(spark, printed, want):
    assert tuple(spark.createDataFrame([(printed,)], "p string").select(web.split_card_name(F.col("p")).alias("n")).first()["n"]) == want


def speaker(i, name, group="SPD"):
    return f'<p klasse="redner"><redner id="{i}"><name><vorname>{name}</vorname><nachname>{name}</nachname><fraktion>{group}</fraktion></name></redner>{name} ({group}):</p>'


REPORT = f"""<dbtplenarprotokoll wahlperiode="21" sitzung-nr="5" sitzung-datum="02.04.2025" sitzung-start-uhrzeit="9:00"><sitzungsverlauf>
<tagesordnungspunkt top-id="Tagesordnungspunkt 1"><p klasse="T_fett">Debatte</p><p klasse="T_Drs">Drucksache 21/77</p><p klasse="J">Ich rufe auf.</p>
<rede id="ID1">{speaker("1 999", "AnnaAnna")}<p klasse="J">Erster Satz.</p><kommentar>(Beifall bei der SPD)</kommentar>{speaker("2", "Bert", "AfD")}<p klasse="J">Eine Frage?</p>
<name>Vizepräsidentin X:</name><p klasse="J">Bitte.</p>{speaker("1", "Anna")}<p klasse="J">Weiter.</p></rede></tagesordnungspunkt>
<tagesordnungspunkt top-id="Tagesordnungspunkt 2"><p klasse="T_fett">Fragestunde</p><name>Präsident:</name><p klasse="J">Frage 1?</p>{speaker("3", "Cem")}<p klasse="J">Antwort.</p><name>Präsident:</name><p klasse="J">Danke.</p></tagesordnungspunkt>
</sitzungsverlauf><anlagen>Dies ist der vorläufige Stenografische Bericht; der endgültige Stenografische Bericht wird am 9. April 2025 veröffentlicht</anlagen></dbtplenarprotokoll>"""


def test_report(spark):
    files = blobs(spark, REPORT.encode())
    walk, heads = protocol.events(files), protocol.headers(files)
    assert rows(protocol.sittings(heads).select("id", "date", "preliminary", "final_announced")) == [("21/5", D(2025, 4, 2), True, D(2025, 4, 9))]
    items = protocol.agenda_items(heads, walk)
    assert [(r["id"], r["title"], r["drucksache_numbers"]) for r in items.orderBy("id").collect()] == [("21/5/1", "Debatte", ["21/77"]), ("21/5/2", "Fragestunde", [])]
    placed = protocol.placed(walk)
    s = protocol.speeches(heads, placed)
    got = [(r["id"], r["person_id"], r["first_name"], r["position"], r["kind"], r["text"]) for r in s.orderBy("position").collect()]
    assert got == [
        ("ID1", "1", "Anna", 1, "rede", "Erster Satz."),
        ("ID1-2", "2", "Bert", 2, "rede", "Eine Frage?"),
        ("ID1-3", "1", "Anna", 3, "rede", "Weiter."),
        ("21/5/2/f1", "3", "Cem", 4, "fragestunde", "Antwort."),
    ]
    p = protocol.speech_paragraphs(s, placed)
    assert rows(p.where("speech_id = 'ID1-2'").select("position", "kind", "text")) == [(1, "text", "Eine Frage?"), (2, "chair", "Vizepräsidentin X:"), (3, "chair", "Bitte.")]
    under = protocol.item_paragraphs(items, placed)
    assert rows(under.select("id", "kind", "after_speeches"))[:3] == [("21/5/1/1", "procedural", 0), ("21/5/1/2", "procedural", 0), ("21/5/1/3", "chair", 0)]
    assert rows(under.where("agenda_item_id = '21/5/2'").select("kind", "text", "after_speeches"))[-1] == ("procedural", "Fragestunde", 3)
    assert rows(protocol.interjections(p).select("speech_id", "kind", "actor", "fraction")) == [("ID1", "beifall", "fraction", "SPD")]


class Fake:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, url, parameters):
        self.asked.append(parameters)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def client(*answers):
    waits = []
    return fetch.Client(Fake(*answers), sleep=waits.append), waits


def test_client_retries():
    c, waits = client((503, b""), ConnectionError("x"), (200, b"ok"))
    assert c.get("u") == b"ok" and waits == [0.5, 2.0, 4.0]
    with pytest.raises(fetch.Unavailable):
        client((404, b""))[0].get("u")
    with pytest.raises(fetch.Blocked):
        client((200, b" <html>"))[0].json("u")


def test_pagination():
    c, _ = client((200, b'{"documents": [1], "cursor": "a"}'), (200, b'{"documents": [2], "cursor": "a"}'))
    assert list(fetch.by_cursor(c, "u")) == [1, 2]
    c, _ = client((200, b'{"data": [1, 2]}'), (200, b'{"data": [3]}'))
    assert list(fetch.by_offset(c, "u", size=2)) == [1, 2, 3]
    assert fetch.until_known(iter([["c", "b"], ["b", "a"], ["a"], ["z"]]), {"a"}) == ["c", "b"]
    assert list(fetch.batches([1, 2, 3], 2)) == [[1, 2], [3]]


def test_planning(spark):
    df = spark.createDataFrame([(5, D(2025, 1, 20)), (7, D(2025, 1, 10))], "n int, d date")
    assert [r["n"] for r in bronze.number_to_fetch(df, "n").collect()] == [8, 9, 10]
    assert bronze.window_to_fetch(df, "d").first()[0] == D(2025, 1, 6)


def test_save_writes_once(tmp_path):
    p = fetch.save(tmp_path, "a/b.json", b"1", "u", "t")
    assert fetch.save(tmp_path, "a/b.json", b"2", "u", "t").read_bytes() == b"1" and json.loads((p.parent / "b.json.meta.json").read_text())["url"] == "u"
