"""Incremental ingestion: files as a stream, late copies within a watermark, upserts by micro-batch, windowed counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.dedup import best_row
from tessera.operators.upsert import upsert


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, per_trigger: int = 1000, fmt: str = "parquet") -> DataFrame:
    """New files of a folder as they come, so many a trigger at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(folder)


def first_copies(stream: DataFrame, keys: Sequence[str], at: str, late: str = "14 days") -> DataFrame:
    """Each key once, as long as copies come no later than ``late``: the batch's look-back as a watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, at: str, window: str, keys: Sequence[str], late: str, slide: str | None = None) -> DataFrame:
    """Counts in tumbling or sliding windows; a window is final when the watermark has passed it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window, slide), *keys).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, at: str, gap: str, keys: Sequence[str], late: str) -> DataFrame:
    """Runs of events of a key with no pause of ``gap`` or longer."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n"))


def upsert_stream(stream: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], keys: Sequence[str], order: Sequence[Column], checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into a table: of a batch's copies of a key the first in ``order`` counts.

    ``read`` gives the current image, ``write`` stores the new one. A batch that runs twice
    after a failure gives the same image, since an upsert of the same rows changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        write(upsert(read(), best_row(batch, keys, order), keys))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("append").start()
