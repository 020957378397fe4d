"""Shared plumbing of the training-data operators: shared storage and Arrow maps."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the `[^\x20\x09-\x0D]+` words.
WHITE = " \t\n\x0b\x0c\r"


#: Rows that a Python operator has as objects at a time.
SLICE = 500


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset a temporary folder is made and set, but only in a session on one
    machine; elsewhere executors would write where nobody else reads.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that driver and executors of {master} share")
        at = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Folders that ``stored`` has written while a list was here.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Lineage ends here: a lost executor costs a reread, not a recomputation, and a
    value that depends on how a task met its rows (a rank within a partition, say)
    is fixed from then on. The files go when the driver's JVM ends, if not before (``noted``).
    """
    spark = df.sparkSession
    to = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (written := _WRITTEN.get()) is not None:
        written.append(to)
    df.write.parquet(to)
    path, files = _hadoop(spark, to)
    files.deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(to)


@contextmanager
def noted(folders: list[str]) -> Iterator[None]:
    """Adds to ``folders`` what ``stored`` writes meanwhile, for ``removed`` once nothing reads it any more."""
    token = _WRITTEN.set(folders)
    try:
        yield
    finally:
        _WRITTEN.reset(token)


def removed(spark: SparkSession, folders: list[str]) -> None:
    """Deletes the folders and empties the list."""
    while folders:
        path, files = _hadoop(spark, folders.pop())
        files.delete(path, True)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, stored; what it has stored on the way, which nothing else reads, is deleted."""
    folders: list[str] = []
    with noted(folders):
        made = make()
    out = stored(made, name)
    removed(spark, folders)
    return out


def handed_on(folders: list[str]) -> None:
    """Leaves ``folders`` to whoever notes what is written, if anyone does."""
    if (written := _WRITTEN.get()) is not None:
        written += folders


def _hadoop(spark: SparkSession, to: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """JVM-side words `[^\\x20\\x09-\\x0D]+`; null and empty texts have none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE[1:], " " * (len(WHITE) - 1))
    return F.array_remove(F.split(spaced, " "), "")


#: Bytes of an Arrow batch where the session sets none: tasks hold few of them, and their buffers stay with the executor.
BATCH_BYTES = 8 << 20
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64MB", "64m")


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH_CONF, _BATCH_DEFAULT[0]) in _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, f"{BATCH_BYTES}b")


#: Words of 64 bits of the bitmap that stands for a set of keys, however many they are.
BITMAP_WORDS = 1 << 20


def _told(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, str, str]:
    """``df`` with ``key`` and whether the one column of ``keys`` may hold it, by a bitmap of hashes of bounded size, and the names of both."""
    name, flag, word, bits = (fresh(df, n) for n in ("key_", "may_be_", "word_", "bits_"))
    one = F.lit(1).cast("bigint")
    at = lambda x: F.pmod(F.xxhash64(x), F.lit(64 * BITMAP_WORDS))
    of = F.col(keys.columns[0])
    bitmap = keys.groupBy(F.shiftright(at(of), 6).alias(word)).agg(
        F.bit_or(F.call_function("shiftleft", one, (at(of) % 64).cast("int"))).alias(bits)
    )
    known = df.withColumn(name, key).withColumn(word, F.shiftright(at(F.col(name)), 6))
    told = known.join(F.broadcast(stored(bitmap, "bitmap")), word, "left")  # BITMAP_WORDS rows at most
    bit = F.call_function("shiftrightunsigned", F.col(bits), (at(F.col(name)) % 64).cast("int")).bitwiseAND(1)
    return told.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop(word, bits), name, flag


def only(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the one column of ``keys``; few others are shuffled, unless the keys are very many."""
    told, name, flag = _told(df, key, keys)
    return told.where(flag).join(keys.withColumnRenamed(keys.columns[0], name), name, "left_semi").select(*_own(df))


def without(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is null or not in the one column of ``keys``; few of those that stay are shuffled, unless the keys are very many."""
    told, name, flag = _told(df, key, keys)
    left = told.where(flag).join(keys.withColumnRenamed(keys.columns[0], name), name, "left_anti")
    return told.where(~F.col(flag)).select(*_own(df)).unionAll(left.select(*_own(df)))


def row_key(docs: DataFrame) -> Column:
    """A row by its doc_id and text: rows that agree in both cannot be told apart by it."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(F.coalesce(F.concat(F.lit("t"), "text"), F.lit("")).cast("binary")).alias("text"))


def _own(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def arrow_map(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str, at_once: int = SLICE) -> DataFrame:
    """``rows`` over each partition: takes column dicts (name to list) of ``at_once`` rows at most, gives column dicts."""
    names, kinds = df.columns, arrow_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A batch may be tens of megabytes of text; as Python objects, only a slice of it is there at a time.
        slices = (b.slice(k, at_once) for b in batches for k in range(0, b.num_rows, at_once))
        columns = ({n: s.column(i).to_pylist() for i, n in enumerate(names)} for s in slices)
        for out in rows(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in kinds], schema=kinds)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
