"""A streaming Spark source over services that list what there is and serve it one by one.

    spark.dataSource.register(ListedRecords)
    spark.readStream.format("listed_records").options(connector="package.module:Connector", folder="/shared/hib", …).load()

Each micro-batch is what a listing brought that was not known. A listing stops where everything is known, and is
written to a journal in ``folder`` before any of it is fetched, so a batch that is run again asks for the same
ids; what an executor fetches is kept in ``folder`` with its sidecar before it is handed on, so it is not
fetched again. An id that is not there yet (404) gives no row and is asked for again with the next listing.
``folder`` is one that driver and executors share; the driver holds the ids that were listed, not what they name.

A connector is a class, made from the options, with ``pages(client)``: lists of ids page by page, the newest
first, and ``url(id)``. Below are those for numbered files, for lists by offset and for lists of another source's records.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tessera.sources.fetch import Client, Missing, batches, save, until_known
from tessera.sources.paged import resolve


class Connector:
    """What a service lists and where it serves it."""

    def __init__(self, options: dict):
        self.options = options

    def pages(self, client: Client) -> Iterator[list[str]]:
        raise NotImplementedError

    def url(self, record: str) -> str:
        return self.options["url"].format(id=record)


class Numbered(Connector):
    """Files numbered from ``first`` to ``last``, one page each, the newest first."""

    def pages(self, client: Client) -> Iterator[list[str]]:
        first, last = int(self.options["first"]), int(self.options["last"])
        width = int(self.options.get("width", 0))
        yield [f"{n:0{width}d}" for n in range(last, first - 1, -1)]


class Offsets(Connector):
    """A list that is asked for by offset, in JSON: ``ids`` newest first and ``days`` of each; ends with the first day before ``since``."""

    def pages(self, client: Client) -> Iterator[list[str]]:
        at, since = 0, self.options.get("since", "")
        while True:
            page = client.json(self.options["list_url"], offset=at)
            ids, days = page.get("ids", []), page.get("days", [])
            if not ids:
                return
            yield [i for i, d in zip(ids, days or [""] * len(ids), strict=True) if not since or not d or d >= since]
            if since and any(d and d < since for d in days):
                return
            at += len(ids)


class Named(Connector):
    """Records that another source's files name: ``ids`` is a text file with an id and a URL a line, as a Spark job has written it."""

    def _named(self) -> dict[str, str]:
        lines = (line.split(maxsplit=1) for path in sorted(Path(self.options["ids"]).glob("part-*")) for line in path.read_text().splitlines())
        return {x[0]: x[1].strip() for x in lines if len(x) == 2}

    def pages(self, client: Client) -> Iterator[list[str]]:
        yield from batches(sorted(self._named(), reverse=True), int(self.options.get("page", 1000)))

    def url(self, record: str) -> str:
        return self._named()[record]


class Journal:
    """What was listed, a file a batch; batches count from 1."""

    def __init__(self, folder: str):
        self.folder = Path(folder) / "_journal"

    def last(self) -> int:
        return max((int(p.stem) for p in self.folder.glob("*.json")), default=0)

    def planned(self) -> int:
        """The last batch that Spark has planned."""
        path = self.folder / "planned"
        return int(path.read_text()) if path.exists() else 0

    def plan(self, batch: int) -> None:
        if batch > self.planned():
            self._put("planned", str(batch))

    def ids(self, batch: int) -> list[str]:
        return json.loads((self.folder / f"{batch:08d}.json").read_text())

    def add(self, ids: list[str]) -> int:
        batch = self.last() + 1
        self._put(f"{batch:08d}.json", json.dumps(ids))
        return batch

    def _put(self, name: str, text: str) -> None:
        self.folder.mkdir(parents=True, exist_ok=True)
        draft = self.folder / f".{name}"
        draft.write_text(text)
        os.replace(draft, self.folder / name)


def kept_at(record: str) -> str:
    """Where the record is kept, under ``folder``: two levels of folders, whatever characters its id has."""
    name = hashlib.sha256(record.encode()).hexdigest()
    return f"{name[:2]}/{name}"


class Ids(InputPartition):
    def __init__(self, batch: int, ids: list[str]):
        super().__init__(batch)
        self.batch, self.ids = batch, ids


class ListedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def _client(self) -> Client:
        o = self.options
        return Client(resolve(o["transport"]), pause=float(o.get("pause", 0.5)), tries=int(o.get("tries", 4)), first_backoff=float(o.get("backoff", 2.0)))

    def _kept(self, record: str) -> bool:
        return (Path(self.options["folder"]) / kept_at(record)).exists()

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        journal = Journal(self.options["folder"])
        last = journal.last()
        listed = {i for k in range(1, last + 1) for i in journal.ids(k)}
        # What was asked for and was not there is asked for again. Spark asks for the latest offset when planned batches are done.
        planned = journal.planned()
        asked = {i for k in range(1, planned + 1) for i in journal.ids(k)} - {i for k in range(planned + 1, last + 1) for i in journal.ids(k)}
        missing = {i for i in asked if not self._kept(i)}
        new = until_known(resolve(self.options["connector"])(self.options).pages(self._client()), listed)
        again = sorted(missing - set(new))
        return {"batch": journal.add([*reversed(new), *again]) if new or again else last}

    def partitions(self, start: dict, end: dict) -> list[Ids]:
        journal, size = Journal(self.options["folder"]), int(self.options.get("size", 50))
        journal.plan(end["batch"])
        return [Ids(k, ids) for k in range(start["batch"] + 1, end["batch"] + 1) for ids in batches(list(dict.fromkeys(journal.ids(k))), size)]

    def read(self, partition: Ids) -> Iterator[tuple]:
        folder, client = Path(self.options["folder"]), self._client()
        connector = resolve(self.options["connector"])(self.options)
        for record in partition.ids:
            path = folder / kept_at(record)
            if not path.exists():
                url = connector.url(record)
                try:
                    body = client.get(url)
                except Missing:
                    continue
                save(folder, kept_at(record), body, url, datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds"))
            about = json.loads(path.with_name(path.name + ".meta.json").read_text())
            yield record, about["url"], about["retrieved_at"], path.read_bytes(), partition.batch

    def commit(self, end: dict) -> None:
        """Nothing goes: the journal is what is known."""


class ListedRecords(DataSource):
    """id, url, retrieved_at, content and the batch of each record."""

    @classmethod
    def name(cls) -> str:
        return "listed_records"

    def schema(self) -> str:
        return "id string, url string, retrieved_at string, content binary, batch int"

    def streamReader(self, schema: StructType) -> ListedReader:  # noqa: N802
        return ListedReader(self.options)
