from pyspark.sql import functions as F

from tessera.plans import questions as Q
from tests.test_plans import Tables
from tests.test_sources import blobs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_turns_of_an_interview_and_a_question_time(spark):
    items = spark.createDataFrame([("i", "Befragung der Bundesregierung", ["21/1"]), ("f", "Fragestunde", ["21/2"]), ("x", "Debatte", [])], "id string, title string, drucksache_numbers array<string>")
    s = [("s1", "i", 1, "min", "Minister", "Bundesminister der Finanzen", None, "rede", "Guten Tag"), ("s2", "i", 2, "a", "A", None, "SPD", "rede", "Warum?"), ("s3", "i", 3, "min", "Minister", None, None, "rede", "Darum"),
         ("s4", "i", 4, "a", "A", None, "SPD", "rede", "Meine Nachfrage"), ("t1", "f", 5, "min", "Minister", "Bundesminister der Finanzen", None, "fragestunde", "Ja"), ("t2", "f", 6, "m", "Muster", None, "AfD", "fragestunde", "Wirklich?"), ("r", "x", 7, "a", "A", None, "SPD", "rede", "Rede")]
    speeches = spark.createDataFrame(s, "id string, agenda_item_id string, position int, person_id string, last_name string, speaker_role string, fraction string, kind string, text string")
    paragraphs = spark.createDataFrame([("s1", 1, "text", "Guten Tag"), ("s1", 2, "chair", "Wir kommen zur ersten Frage."), ("s3", 1, "chair", "Bitte."), ("s3", 2, "text", "Darum")], "speech_id string, position int, kind string, text string")
    under = spark.createDataFrame([("f", 1, "chair", 4, "Wir kommen zur Frage 3 des Abgeordneten Max Muster:"), ("f", 2, "chair", 4, "Was nun?")], "agenda_item_id string, position int, kind string, after_speeches int, text string")
    got = {r[0]: (r[1], r[2]) for r in Q.question_turns(speeches, paragraphs, under, items).collect()}
    assert got == {"s1": ("einleitung", None), "s2": ("frage", "s2"), "s3": ("antwort", "s2"), "s4": ("nachfrage", "s2"), "t1": ("antwort", "t1"), "t2": ("nachfrage", "t1")}
    calls = Q.spoken_calls(under, items)
    assert rows(calls.select("number", "name", "text", "drucksache_number")) == [("3", "Max Muster", "Was nun?", "21/2")]


def test_threads_of_an_interview(spark):
    said = {2: "Wir kommen zur ersten Frage.", 4: "Eine Nachfrage?", 6: "Die nächste Nachfrage hat Frau B.", 7: "Herr C, bitte."}
    who = ["min", "a", "min", "a", "min", "b", "c", "min", "c"]
    t = [(str(k), "i", k, p, p == "min" and k == 1, "") for k, p in enumerate(who, 1)]
    turns = spark.createDataFrame(t, "id string, agenda_item_id string, position int, person_id string, official boolean, text string").withColumn("official", F.col("person_id") == "min")
    under = spark.createDataFrame([("i", k, "chair", k - 1, x) for k, x in said.items()], "agenda_item_id string, position int, kind string, after_speeches int, text string")
    none = spark.createDataFrame([], "speech_id string, position int, kind string, text string")
    got = {r[0]: (r[1], r[2]) for r in Q.interviews(turns, none, under).collect()}
    assert [got[str(k)][0] for k in range(1, 10)] == ["einleitung", "frage", "antwort", "nachfrage", "antwort", "zusatzfrage", "frage", "antwort", "nachfrage"]
    assert [got[str(k)][1] for k in range(1, 10)] == [None, "2", "2", "2", "2", "2", "7", "7", "7"]


def test_questions_read_out(spark):
    p = [("f", 1, "chair", 0, "Wir kommen zur Frage 3 des Abgeordneten Max von Muster, SPD:"), ("f", 2, "chair", 0, "Erster Teil."), ("f", 3, "chair", 0, "Was nun?"),
         ("f", 4, "chair", 2, "Die Frage 4 der Kollegin Eva Test wird schriftlich beantwortet."), ("f", 5, "chair", 3, "Es geht los mit der zweiten Frage der Kollegin Özdemir:"), ("f", 6, "chair", 3, "Wie?")]
    under = spark.createDataFrame(p, "agenda_item_id string, position int, kind string, after_speeches int, text string")
    items = spark.createDataFrame([("f", ["21/2"])], "id string, drucksache_numbers array<string>")
    calls = Q.spoken_calls(under, items)
    assert rows(calls.select("number", "name", "text", "after_speeches")) == [("2", "Özdemir", "Wie?", 3), ("3", "Max von Muster", "Erster Teil.\n\nWas nun?", 0)]
    spoke = spark.createDataFrame([("s1", "f", 1), ("s2", "f", 2), ("s4", "f", 5)], "id string, agenda_item_id string, position int")
    assert rows(Q.spoken_calls(under, items, spoke).select("number", "thread_id")) == [("2", "s4"), ("3", "s1")]
    assert rows(Q.spoken_calls(under, items, spoke.where("position > 4")).select("number", "thread_id")) == [("2", "s4"), ("3", None)]
    turns = spark.createDataFrame([("s1", "f", 1, "Minister", True), ("s2", "f", 2, "Muster", False), ("s3", "f", 3, "Test", False), ("s4", "f", 5, "Oezdemir", False)], "id string, agenda_item_id string, position int, last_name string, official boolean")
    assert rows(Q.question_times(turns, calls)) == [("s1", "antwort", "s1"), ("s2", "nachfrage", "s1"), ("s3", "zusatzfrage", "s1"), ("s4", "nachfrage", "s4")]


ANNEX = """<r><anlagen><anlage><anlagen-text anlagen-typ="Schriftliche Antworten auf Fragen der Fragestunde (Drucksache 21/2)">
<p klasse="AnlageU">Fragen 4 und 5</p><p klasse="O">Fragen des Abgeordneten Max Muster (AfD):</p><p klasse="p">Erstens?</p><p klasse="p">Zweitens?</p>
<p klasse="O">Antwort des Staatssekretärs Bert Test:</p><p klasse="J">Beides.</p><table><thead><tr><th colspan="2">Kopf</th></tr></thead><tbody><tr><td>a</td><td>b</td></tr></tbody></table><p klasse="J">Ende.</p>
<p klasse="AnlageU">Frage 6</p><p klasse="O">Frage der Abgeordneten Eva Test (SPD):</p><p klasse="p">Drittens?</p><p klasse="J">Die Antwort lag bei Redaktionsschluss noch nicht vor.</p>
</anlagen-text></anlage></anlagen></r>"""


def test_annex_and_texts(spark):
    annex = Q.annex_answers(blobs(spark, ANNEX.encode()))
    e = annex.orderBy("n").collect()
    assert e[0]["numbers"] == ["4", "5"] and e[0]["answer"] == ["Beides.", "Ende."] and e[0]["tables"][0]["after"] == 1 and '"colspan": 2' in e[0]["tables"][0]["cells"]
    assert e[1]["answered"] is False
    own = spark.createDataFrame([("f0", "21/1002"), ("f0", "21/7")], "path string, document string")
    path = annex.head()["path"]
    assert {r["document"] for r in Q.annex_answers(blobs(spark, ANNEX.encode()), own.withColumn("path", F.lit(path))).collect()} == {"21/1002"}
    assert {r["document"] for r in Q.annex_answers(blobs(spark, ANNEX.encode()), own.where("document = '21/7'").withColumn("path", F.lit(path))).collect()} == {"21/2"}
    calls = spark.createDataFrame([("21/2", 3, "4", "Zuerst gelesen?", "Muster")], "drucksache_number string, after_speeches int, number string, text string, name string")
    got = {r["id"]: (r["text"], r["name"]) for r in Q.question_texts(calls, annex).collect()}
    assert got == {
        "21/2/4/frage": ("Zuerst gelesen?", "Muster"),
        "21/2/5/frage": ("Zweitens?", "Max Muster"),
        "21/2/4/antwort": ("Beides.\n\nEnde.", "Staatssekretärs Bert Test"),
        "21/2/5/antwort": ("Beides.\n\nEnde.", "Staatssekretärs Bert Test"),
        "21/2/6/frage": ("Drittens?", "Eva Test"),
    }


def test_procedures_of_questions(spark):
    asked = spark.createDataFrame([("d", "1", "Max Muster", "Wie steht es um Brücken und Straßen?"), ("d", "2", "Max Muster", "Wann kommen neue Bahnhöfe?")], "document string, number string, name string, text string")
    acts = spark.createDataFrame([("d", "10", "Max Muster, MdB, AfD", "Bahnhöfe in neuer Planung"), ("d", "11", "Max Muster, MdB, AfD", "Zustand von Brücken, Straßen")], "document string, vorgang_id string, name string, title string")
    assert rows(Q.spoken_procedures(asked, acts)) == [("d", "1", "11"), ("d", "2", "10")]
    # Left over: no activity of the sitting, or fewer than questions.
    more = asked.unionByName(spark.createDataFrame([("d", "3", "Max Muster", "Und was?"), ("d", "4", "Eva Test", "Wie?"), ("d", "5", "Eva Test", "Wo?"), ("d", "6", "Ohne Liste", "Wer?")], asked.schema))
    listed = spark.createDataFrame([("d", v, n) for v, n in (("10", "Max Muster, MdB"), ("11", "Max Muster, MdB"), ("12", "Max Muster, MdB"), ("30", "Eva Test, MdB"), ("9", "Eva Test, MdB"), ("31", "Eva Test, MdB"))], "document string, vorgang_id string, name string")
    assert rows(Q.spoken_procedures(more.where("number != '3'"), acts, listed)) == [("d", "1", "11"), ("d", "2", "10"), ("d", "4", "9"), ("d", "5", "30")]
    assert ("d", "3", "12") in rows(Q.spoken_procedures(more.where("number IN ('3', '4')"), acts.where("false"), listed.where("vorgang_id > '11'")))
    asked = spark.createDataFrame([("d", n, "Eva Test") for n in ("1", "3", "7")] + [("d", "4", "Max Muster")], "document string, number string, name string")
    acts = spark.createDataFrame([("d", "9", "Test, MdB", "1"), ("d", "10", "Test, MdB", "1, 2"), ("d", "11", "Test, MdB", "4"), ("d", "12", "Test, MdB", "8")], "document string, vorgang_id string, name string, question_numbers string")
    assert rows(Q.written_procedures(asked, acts)) == [("d", "1", "10"), ("d", "3", "11"), ("d", "7", "12")]


def test_profiles_and_portraits(spark):
    t = Tables(spark, person=[{"id": "1", "first_name": "Anna", "last_name": "Muster", "fraction": "SPD"}, {"id": "2", "first_name": "Bernd", "last_name": "von der Test", "fraction": "AfD"}])
    r = spark.createDataFrame([(7, "Anna", "Muster", None, "u", 3, 2, "a", "t"), (8, "Niemand", "Fremd", None, "u", None, None, "a", "t")], "id long, first_name string, last_name string, year_of_birth string, abgeordnetenwatch_url string, statistic_questions int, statistic_questions_answered int, api_url string, retrieved_at string")
    assert rows(Q.profiles(r, t["person"], t["mandate"], 21).select("aw_politician_id", "person_id", "questions")) == [(7, "1", 3), (8, None, None)]
    cards = spark.createDataFrame([("p", 1, "Muster", "Anna", "SPD", "b", "old", None), ("q", 1, "Muster", "Anna", "SPD", "b", "new", "c"), ("p", 2, "Neu Test", "Bernd", "AfD", "b", "i2", None)], "path string, n int, last_name string, first_name string, fraction string, bio_url string, image_url string, credit string")
    others = spark.createDataFrame([("1", "wiki", "w"), ("3", "wiki3", "w")], "person_id string, image_url string, credit string")
    assert rows(Q.portraits(cards, t["person"], t["mandate"], 21, others).select("person_id", "image_url")) == [("1", "new"), ("2", "i2"), ("3", "wiki3")]


def test_offices_not_in_roster(spark):
    t = Tables(spark, speech=[{"id": "1", "person_id": "5", "speaker_role": "Bundesminister der Finanzen"}, {"id": "2", "person_id": "6", "speaker_role": "Gast"}, {"id": "3", "person_id": "7", "speaker_role": "Bundeskanzler"}],
               government_role=[{"id": "g", "person_id": "7", "from_date": None}])
    assert rows(Q.offices_not_in_roster(t).select(F.col("person_id"))) == [("5",)]
