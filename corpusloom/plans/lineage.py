"""Cutting lineage through the shared checkpoint folder, and deciding on a broadcast."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of at most this many counted rows is broadcast.
BROADCAST_ROWS = 10_000


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the folder that spark.checkpoint.dir names. Where it is unset, a local session gets a
    temporary one; a cluster has none that all its machines see, which is an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return df.checkpoint(eager=True)


def dealt(stated: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """A stated set dealt by key into parts of at most about ``rows`` rows."""
    n = stated.count()
    if n <= rows:
        return [stated]
    parts = -(-2 * n // rows)
    return [stated.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part) for part in range(parts)]


def in_blocks(stated: DataFrame, key: str, rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """The parts of a stated set, each to be broadcast in a turn of its own: what meets it is scanned once a
    part, and no row is shuffled."""
    return [F.broadcast(part) for part in dealt(stated, key, rows)]


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
