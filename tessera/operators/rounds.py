"""What iterative operators need: lineage cut where driver and executors both can read."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame

#: Rows that a task sorts at a time, about.
ROWS = 1 << 19


def dealt(df: DataFrame, rows: int, *keys: str | Column) -> DataFrame:
    """``df`` dealt by ``keys`` into as many partitions as ``rows`` asks for: a task's share does not grow with the table."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // ROWS)), *keys)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as it is now, kept in the folder of ``spark.checkpoint.dir``, so that a lost executor costs a reread.

    Where no folder is set, a session on one machine gets a temporary one; elsewhere it is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        at = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if at is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that driver and executors of {context.master} share")
        context.setCheckpointDir(at or "file://" + tempfile.mkdtemp(prefix="tessera-"))
    return df.checkpoint()
