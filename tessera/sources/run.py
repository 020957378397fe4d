"""Runs a parser over files, one file at a time on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema


def per_file(files: DataFrame, parse: Callable[[str, bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that ``parse(path, content)`` gives for each file of ``files`` (path, content).

    Files are read one after the other, so a task holds one file and its rows.
    """
    kinds = to_arrow_schema(files.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = list(parse(path, content))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    return files.select("path", "content").mapInArrow(run, schema)
