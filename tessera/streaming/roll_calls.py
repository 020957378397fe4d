"""Decisions of sittings as they come in, where the totals of a roll call may be read out in the next sitting.

A sitting is read once: roll calls that wait for their totals are kept as the state of their period, and go to the
reader of the next sitting. A timer gives them up if no other sitting follows. ``plans.steps.decisions`` gives the
same for tables, where each sitting reads its neighbours instead.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.functions import decisions as D

#: Rows that come out: a decision as it is known, and again once its totals are read out; the greatest ``seen`` of an id is the newest.
OUT = "sitting_id string, id string, agenda_item_id string, position int, kind string, subject string, drucksache_number string, result string, yes int, no int, abstain int, seen string, given_up boolean"
STATE = T.StructType([T.StructField("waiting", T.StringType()), T.StructField("until", T.LongType())])


class Waiting(StatefulProcessor):
    """Key: period. State: the last sitting's roll calls without totals, each with its id and place, and when they are given up."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("waiting", STATE)

    def _held(self) -> tuple[list[tuple[dict, D.Decision]], int | None]:
        if not self.state.exists():
            return [], None
        text, until = self.state.get()
        return [(x["about"], D.Decision(**{k: tuple(v) if k == "counts" and v else v for k, v in x["decision"].items()})) for x in json.loads(text)], until

    def _keep(self, waiting: list[tuple[dict, D.Decision]], day: str, before: int | None) -> None:
        if before is not None:
            self.handle.deleteTimer(before)
        if not waiting:
            self.state.clear()
            return
        moment = datetime.datetime.fromisoformat(day).replace(tzinfo=datetime.UTC) + datetime.timedelta(days=self.days)
        until = int(moment.timestamp() * 1000)
        self.state.update((json.dumps([{"about": a, "decision": asdict(d)} for a, d in waiting], ensure_ascii=False), until))
        self.handle.registerTimer(until)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        said = pd.concat(rows)
        out = []
        for (_, sitting), own in said.groupby([said["sitting_id"].str.split("/").str[1].astype(int), "sitting_id"]):
            own, day = own.sort_values("paragraph"), str(own["day"].iloc[0])
            before, until = self._held()
            reader = D.Reader(int(key[0]), [d for _, d in before])
            stream = [
                D.Sentence(i, int(p), s, None if pd.isna(at) else int(at))
                for i, p, at, t in zip(own["agenda_item_id"], own["paragraph"], own["at"], own["text"], strict=True)
                for s in D.sentences(t)
            ]
            found = reader.read(stream)
            mine = [({"sitting_id": sitting, "id": i, "position": k}, d) for k, (d, i) in enumerate(zip(found, D.anchored(found, sitting), strict=True), start=1)]
            told = [(a, d) for a, d in before if not any(d is x for x in reader.waiting)]
            out += [self._row(a, d, day) for a, d in [*told, *mine]]
            self._keep([(a, d) for a, d in mine if any(d is x for x in reader.waiting)], day, until)
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        waiting, until = self._held()
        due = until is not None and until <= expiredTimerInfo.getExpiryTimeInMs()
        if due:
            self.state.clear()
        day = datetime.datetime.fromtimestamp((until or 0) / 1000, datetime.UTC).date().isoformat()
        yield pd.DataFrame([(*self._row(a, d, day)[:-1], True) for a, d in waiting if due], columns=[c.split(" ")[0] for c in OUT.split(", ")])

    @staticmethod
    def _row(about: dict, d: D.Decision, day: str) -> tuple:
        yes, no, abstain = d.counts or (None, None, None)
        return about["sitting_id"], about["id"], d.item, about["position"], d.kind, d.subject, d.number, d.result, yes, no, abstain, day, False

    def close(self) -> None:
        """Nothing is held outside the state."""


def decisions_stream(chair: DataFrame, days: int = 30) -> DataFrame:
    """Decisions of a stream of the chair's paragraphs: sitting_id ("21/5"), day (a date), agenda_item_id, paragraph, at, text.

    A sitting comes whole in one micro-batch, and sittings of a period in order. A roll call without totals comes out
    at once and again when the next sitting has them; after ``days`` without another sitting it comes out as given up.
    """
    timed = chair.withColumns({"period": F.split("sitting_id", "/")[0], "moment": F.col("day").cast("timestamp")}).withWatermark("moment", "0 seconds")
    return timed.groupBy("period").transformWithStateInPandas(statefulProcessor=Waiting(days), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def newest(found: DataFrame) -> DataFrame:
    """The last row of each decision."""
    last = F.max_by(F.struct(*(c for c in found.columns if c != "id")), F.struct("given_up", "seen", F.col("yes").isNotNull()))
    return found.groupBy("id").agg(last.alias("row")).select("id", "row.*")
