"""A Spark data source over paged services: one partition a range of days, each read page by page by an executor.

    spark.dataSource.register(PagedRecords)
    spark.read.format("paged_records").options(url=…, transport="package.module:function", start="2025-01-01",
        end="2025-03-31", days=14).load()

The transport is named, so executors import it; it takes (url, parameters) and gives
(status, body). A range that fails is tried anew by Spark as a task, besides the client's
own retries; pacing holds within a task, so ``parallel`` ranges at a time is what the
service has to bear (``spark.read…`` and ``coalesce``).
"""

from __future__ import annotations

import datetime
import importlib
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tessera.sources.fetch import Client, by_cursor


class Days(InputPartition):
    def __init__(self, start: str, end: str):
        super().__init__(f"{start}/{end}")
        self.start, self.end = start, end


def ranges(start: datetime.date, end: datetime.date, days: int) -> list[tuple[datetime.date, datetime.date]]:
    """Consecutive ranges of so many days, both ends included; none if the start is after the end."""
    out = []
    while start <= end:
        last = min(end, start + datetime.timedelta(days=days - 1))
        out.append((start, last))
        start = last + datetime.timedelta(days=1)
    return out


def resolve(name: str):
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Days]:
        day = datetime.date.fromisoformat
        o = self.options
        return [Days(a.isoformat(), b.isoformat()) for a, b in ranges(day(o["start"]), day(o["end"]), int(o.get("days", 14)))]

    def read(self, partition: Days) -> Iterator[tuple]:
        o = self.options
        client = Client(resolve(o["transport"]), pause=float(o.get("pause", 0.5)))
        about = {o.get("start_parameter", "f.datum.start"): partition.start, o.get("end_parameter", "f.datum.end"): partition.end}
        for record in by_cursor(client, o["url"], o.get("records", "documents"), **about):
            yield str(record.get("id")), json.dumps(record, ensure_ascii=False), partition.start, partition.end


class PagedRecords(DataSource):
    """id and JSON text of each record, with the range of days it was asked for."""

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def schema(self) -> str:
        return "id string, record string, range_start string, range_end string"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self.options)
