"""What the operators share: reading a table, cutting lineage, and deciding on a broadcast."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of ``[\x20\x09-\x0D]``.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: A table is broadcast only when this many bytes are certain to hold it.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of rows handed to Python at once, whatever their number.
BATCH_BYTES = 4 << 20


def modest_batches(df: DataFrame, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most so many rows and BATCH_BYTES; the defaults hold far more
    memory. The session keeps these bounds, for frames run later; they change no result."""
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(conf.get(key).rstrip("b") or 0)
        if now <= 0 or now > most:
            conf.set(key, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Without one, a local session gets a
    temporary folder; a cluster has none that all its machines see, which is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="corpusloom-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of frames that are no longer referenced.

    The cleaner works behind the driver's garbage collection, and a frame's Python and Java halves
    are let go one after the other: so it is asked more than once, with time to follow.
    """
    import gc
    import time

    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def shrink(spark: SparkSession) -> None:
    """Let executors give back heap that earlier steps grew and no longer fill.

    Java keeps a grown heap until a full collection. One task a core asks for it, so that every idle
    executor gets one; no result depends on where they run.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).collect()


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows fit BROADCAST_BYTES, else as it is (a shuffled join)."""
    limit = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    """The join condition that treats nulls as equal."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond
