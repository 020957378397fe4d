import datetime
import json

from tessera import cli
from tessera.plans import pipeline, steps
from tessera.plans.schemas import violations
from tessera.plans.store import Store
from tessera.sources import protocol
from tests.test_sources import REPORT, blobs

D = datetime.date
P = dict(source_url="u", source_document_id="d", retrieved_at="t")


def raw_inputs(spark):
    from pyspark.sql import functions as F

    files = blobs(spark, REPORT.encode())
    walk, heads = protocol.events(files), protocol.headers(files)
    placed = protocol.placed(walk)
    items, speeches = protocol.agenda_items(heads, walk), protocol.speeches(heads, placed)
    paragraphs, under = protocol.speech_paragraphs(speeches, placed), protocol.item_paragraphs(items, placed)
    source = {k: F.lit(v) for k, v in P.items()}
    subs = steps.sub_items(under)
    spoken = steps.speeches_in_sub_items(speeches.withColumn("sub_item_id", F.lit(None).cast("string")), under, subs)
    person = spark.createDataFrame([("1", "Anna", "Anna", True, *P.values())], "id string, first_name string, last_name string, is_mdb boolean, source_url string, source_document_id string, retrieved_at string")
    mandate = spark.createDataFrame([("1/21", "1", 21, D(2025, 3, 25), *P.values())], "id string, person_id string, wahlperiode int, from_date date, source_url string, source_document_id string, retrieved_at string")
    membership = spark.createDataFrame([("1/21/1", "1", 21, "fraction", "SPD", *P.values())], "id string, person_id string, wahlperiode int, kind string, name string, source_url string, source_document_id string, retrieved_at string")
    votes = spark.createDataFrame([("21/5/1", 21, 1, "Anna", "Anna", "SPD", "yes"), ("21/5/1", 21, 2, "Fremd", "X", "AfD", "no")], "vote_id string, wahlperiode int, row int, last_name string, first_name string, fraction string, vote string")
    vote = spark.createDataFrame([("21/5/1", "21/5", 1, D(2025, 4, 2), "zu 21/77", "21/77", 1, 1, 0, 0, 0, "x", *P.values())], "id string, sitting_id string, number int, date date, title string, drucksache_number string, yes int, no int, abstain int, invalid int, absent int, xlsx_url string, source_url string, source_document_id string, retrieved_at string")
    return {
        "members_person": person, "members_mandate": mandate, "members_membership": membership,
        "report_sitting": protocol.sittings(heads).withColumns(source | {"xml_url": F.lit("x"), "pdf_url": F.lit("p")}),
        "report_agenda_item": items.withColumns(source | {"no_debate": F.lit(False)}),
        "report_agenda_sub_item": subs.withColumns(source),
        "report_agenda_item_paragraph": under.withColumns(source),
        "report_speech": spoken.withColumns(source | {"speaker_name": F.col("printed")}),
        "report_speech_paragraph": paragraphs,
        "report_interjection": protocol.interjections(paragraphs),
        "report_person": speeches.select(F.col("person_id").alias("id"), "first_name", "last_name").distinct().withColumns(source),
        "vote_rows": votes, "vote_list": vote,
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_build_is_idempotent_and_sound(spark, tmp_path, capsys):
    store, raw = Store(spark, f"file://{tmp_path}/store"), raw_inputs(spark)
    ran = pipeline.build(store, raw)
    assert ran == ["members", "reports", "votes", "item_documents", "question_status", "groups", "speech_parts"]
    names = ("person", "speech", "speech_paragraph", "interjection", "agenda_item", "agenda_item_vorlage", "individual_vote", "roll_call_vote", "sitting")
    first = {n: rows(store.table(n)) for n in names}
    assert {r[0]: r[1] for r in store.table("speech").select("id", "interruption").collect()} == {"ID1": None, "ID1-2": "zwischenfrage", "ID1-3": None, "21/5/2/f1": None}
    assert rows(store.table("individual_vote").select("last_name", "person_id")) == [("Anna", "1"), ("Fremd", None)]
    assert rows(store.table("roll_call_vote").select("agenda_item_id")) == [("21/5/1",)]
    assert {r["id"]: r["is_mdb"] for r in store.table("person").collect()} == {"1": True, "2": False, "3": False}
    assert rows(violations({n: store.table(n) for n in names})) == []
    pipeline.build(store, raw)
    assert {n: rows(store.table(n)) for n in names} == first

    root = f"file://{tmp_path}/store"
    assert cli.main([root, "query", "speeches", "--person", "Anna", "--from", "2025-01-01", "--to", "2025-12-31", "--json"], spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [x["speech_id"] for x in said] == ["ID1", "ID1-3"] and said[0]["date"] == "2025-04-02"
    assert cli.main([root, "query", "votes", "--person", "Niemand", "--from", "2025-01-01", "--to", "2025-12-31"], spark) == 2
    snapshots = f"file://{tmp_path}/snapshots"
    assert cli.main([root, "health", "--snapshots", snapshots, "--day", "2025-05-01"], spark) == 0
    store.write({"speech": store.table("speech").where("kind = 'fragestunde'")})
    assert cli.main([root, "health", "--snapshots", snapshots, "--day", "2025-05-08"], spark) == 1
    assert "FAIL speech" in capsys.readouterr().out
    assert cli.main([root, "export", str(tmp_path / "out")], spark) == 0
    assert len(list((tmp_path / "out").glob("*.csv.gz"))) == 40
