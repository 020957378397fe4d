"""The corpus pipeline: from raw documents to packed training sequences.

Five stages, each a (name, function) of STAGES that takes (spark, docs, sf_dir) and
returns a DataFrame; every stage but the last returns the columns of ``documents``.
Each sees exactly what the stage before it kept:

1. quality_classifier: documents that the quadratic discriminant rejects go.
2. near_duplicates: of each group of near copies (SimHash of five-word shingles, similarity 0.8 or more), the document
   with the smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. secrets: secrets in texts are replaced by a mark; n_chars follows.
5. packing: what is left is cut and packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontamination, near_copies, packing, quality_classifier, secrets
from tessera.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier, fitted on ``labels``, predicts to be good.

    Null and empty texts are scored like any other; repeated rows get the same verdict;
    without labels nothing is rejected for want of a model; no rows give none; all
    columns go through.
    """
    return quality_classifier.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id.

    Null and empty texts are one group; of repeated rows one stays; null doc_ids come
    last; no rows give none; all columns go through.
    """
    return near_copies.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without a window of ten words of any ``benchmark`` item.

    Null and empty texts stay; repeated rows stay or go together; items without words
    match nothing; no rows give none; all columns go through.
    """
    return decontamination.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, secrets in its text replaced; n_chars follows. Null texts stay null; no rows give none."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset; a null or empty text is a document of one id; no rows give none."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the fingerprints; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's output written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
