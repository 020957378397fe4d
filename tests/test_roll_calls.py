"""Roll calls that wait for the next sitting: the stream against the tables."""

import datetime

from pyspark.sql import functions as F

from tessera.plans import steps
from tessera.streaming import roll_calls as R

PARAGRAPHS = "sitting_id string, day date, agenda_item_id string, paragraph int, at int, text string"
OPENED = "Wir stimmen namentlich ab über den Antrag auf Drucksache 21/{0}. Ich eröffne die namentliche Abstimmung über den Antrag auf Drucksache 21/{0}."
TOTALS = "Das Ergebnis der namentlichen Abstimmung: Mit Ja haben gestimmt {1}, mit Nein haben gestimmt {2}, Enthaltungen keine. Der Antrag auf Drucksache 21/{0} ist {3}."
HANDS = "Wer stimmt für den Antrag auf Drucksache 21/{0}? – Die Koalition. Wer stimmt dagegen? – Die Opposition. Der Antrag ist angenommen."

SITTINGS = [
    ("21/8", 1, [OPENED.format(3), TOTALS.format(3, 20, 30, "abgelehnt")]),
    ("21/9", 2, [OPENED.format(4), OPENED.format(5), HANDS.format(6)]),
    ("21/10", 3, [TOTALS.format(5, 50, 40, "angenommen"), TOTALS.format(4, 1, 2, "abgelehnt"), OPENED.format(7)]),
    ("21/11", 4, [HANDS.format(8)]),
    ("21/12", 5, [TOTALS.format(7, 9, 8, "angenommen"), OPENED.format(9)]),
    ("21/13", 80, ["Guten Morgen."]),
]


def paragraphs(sitting):
    name, day, said = sitting
    return [(name, datetime.date(2025, 1, 1) + datetime.timedelta(day), f"{name}/1", k, k, t) for k, t in enumerate(said, 1)]


class Runs:
    """A run of the stream for each sitting: the state outlives the query."""

    def __init__(self, spark, at):
        self.spark, self.at = spark, at

    def __call__(self, sittings):
        name = "spark.sql.streaming.stateStore.providerClass"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        try:
            for sitting in sittings:
                self.spark.createDataFrame(paragraphs(sitting), PARAGRAPHS).coalesce(1).write.mode("append").parquet(str(self.at / "in"))
                stream = R.decisions_stream(self.spark.readStream.schema(PARAGRAPHS).parquet(str(self.at / "in")))
                q = stream.writeStream.format("parquet").option("path", str(self.at / "out")).option("checkpointLocation", str(self.at / "check")).outputMode("append").trigger(availableNow=True).start()
                q.awaitTermination(120)
        finally:
            self.spark.conf.set(name, before)
        return self.spark.read.parquet(str(self.at / "out"))


def test_roll_calls_are_given_up(spark, tmp_path):
    out = Runs(spark, tmp_path)([SITTINGS[1], ("20/1", 80, ["Guten Morgen."]), ("20/2", 81, ["Guten Tag."])])
    rows = {r["id"]: (r["given_up"], r["result"]) for r in R.newest(out).collect()}
    assert rows == {"21/9/n1": (True, None), "21/9/n2": (True, None), "21/9/p3": (False, "angenommen")}


def test_the_stream_equals_the_tables(spark, tmp_path):
    out = Runs(spark, tmp_path)(SITTINGS)
    got = {r["id"]: (r["sitting_id"], r["agenda_item_id"], r["kind"], r["subject"], r["drucksache_number"], r["result"]) for r in R.newest(out).collect()}
    chair = spark.createDataFrame([p for s in SITTINGS for p in paragraphs(s)], PARAGRAPHS).drop("day")
    votes = spark.createDataFrame([], "sitting_id string, id string, number int, yes int, no int, drucksache_number string")
    want = {r["id"]: (r["sitting_id"], r["agenda_item_id"], r["kind"], r["subject"], r["drucksache_number"], r["result"]) for r in steps.decisions(chair, votes, 21).collect()}
    assert got == want and len(want) == 8
    assert {k: v[5] for k, v in got.items() if v[2] == "namentlich"} == {"21/8/n1": "abgelehnt", "21/9/n1": "abgelehnt", "21/9/n2": "angenommen", "21/10/n1": None, "21/12/n1": "angenommen", "21/12/n2": None}
    totals = {r["id"]: (r["yes"], r["no"]) for r in R.newest(out).where("kind = 'namentlich'").collect()}
    assert totals["21/9/n2"] == (50, 40) and totals["21/10/n1"] == (None, None)
    twice = {r["id"] for r in out.groupBy("id").count().where("count > 1").collect()}
    assert {"21/9/n1", "21/9/n2"} <= twice and out.where(F.col("id") == "21/8/n1").count() == 1
