"""Raw files with their provenance, and which of them still have to be parsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import latest

SIDECAR = ".meta.json"
META = T.StructType([T.StructField("url", T.StringType()), T.StructField("retrieved_at", T.StringType())])


def data_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, length, modified and content of the files, sidecars left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.where(~F.endswith("path", F.lit(SIDECAR))).select(
        "path", "length", F.col("modificationTime").alias("modified"), "content"
    )


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """path of the file that a sidecar describes, url, retrieved_at."""
    meta = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SIDECAR}").option("recursiveFileLookup", True).load(folder)
    parsed = F.from_json(F.decode("content", "UTF-8"), META)
    return meta.select(
        F.expr(f"left(path, length(path) - {len(SIDECAR)})").alias("path"),
        parsed["url"].alias("source_url"),
        parsed["retrieved_at"].alias("retrieved_at"),
    )


def with_provenance(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Files with url and time of retrieval; a file without a sidecar keeps nulls, which the checks report."""
    return files.join(meta, "path", "left")


def text(files: DataFrame) -> DataFrame:
    """content as UTF-8 text, a byte order mark left off."""
    return files.withColumn("content", F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", ""))


def json_records(files: DataFrame, schema: T.StructType) -> DataFrame:
    """One row a record of JSON files that hold an array or a single object (S3)."""
    body = F.trim(F.col("content"))
    records = F.when(F.startswith(body, F.lit("[")), F.from_json(body, T.ArrayType(schema))).otherwise(F.array(F.from_json(body, schema)))
    rest = [c for c in files.columns if c != "content"]
    return files.select(*rest, F.explode(records).alias("record")).select(*rest, "record.*")


def latest_records(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of overlapping files, each record once: the newest retrieval, then the later path."""
    return latest(records, keys, "retrieved_at", "path")


def unparsed(files: DataFrame, parsed: DataFrame, version: int) -> DataFrame:
    """Files that no earlier run of this parser version has read as they are now."""
    done = parsed.where(F.col("parser_version") == version).select("path", "length", "modified")
    return files.join(done, ["path", "length", "modified"], "left_anti")


def number_to_fetch(known: DataFrame, number: str, misses: int = 3) -> DataFrame:
    """The next numbers to try: after the greatest known one, until ``misses`` in a row are not there."""
    top = known.agg(F.coalesce(F.max(number), F.lit(0)).alias("last"))
    return top.select(F.explode(F.sequence(F.col("last") + 1, F.col("last") + misses)).alias(number))


def window_to_fetch(known: DataFrame, day: str, lookback: int = 14) -> DataFrame:
    """The first day to fetch anew: late publications change what was already read."""
    return known.agg(F.date_sub(F.max(day), lookback).alias("fetch_from"))
