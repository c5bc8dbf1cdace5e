"""Writing: staged, verified, swapped by rename, with a backup and a rollback; dry by default."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class VerificationError(RuntimeError):
    """A staged table differs from what was planned; nothing was swapped."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def swap(spark: SparkSession, staged: str, target: str, now: datetime.datetime | None = None) -> str | None:
    """Rename target to a timestamped backup and staged to target; undo the first if the second fails."""
    fs, path = _fs(spark, target)
    backup = None
    if fs.exists(path(target)):
        backup = f"{target}.backup_{(now or datetime.datetime.now()).strftime('%Y%m%d_%H%M%S')}"
        if not fs.rename(path(target), path(backup)):
            raise OSError(f"cannot move {target}")
    try:
        if not fs.rename(path(staged), path(target)):
            raise OSError(f"cannot move {staged}")
    except Exception:
        if backup:
            fs.rename(path(backup), path(target))
        raise
    return backup


def replace_table(df: DataFrame, target: str, verify: Callable[[DataFrame], DataFrame] | None = None, apply: bool = False, fmt: str = "parquet") -> DataFrame | None:
    """Write df beside target, verify what was written, and swap it in.

    Without ``apply`` nothing is written and the plan (df) is returned. ``verify`` maps the reread
    table to a frame of problems, of which there must be none.
    """
    if not apply:
        return df
    spark, staged = df.sparkSession, f"{target}.staging"
    df.write.mode("overwrite").format(fmt).save(staged)
    if verify is not None:
        problems = verify(spark.read.format(fmt).load(staged)).take(20)
        if problems:
            raise VerificationError("; ".join(map(str, problems)))
    swap(spark, staged, target)
    return None


def write_dossiers(df: DataFrame, path: str) -> None:
    """One JSON object per row, a folder per dossier."""
    df.write.mode("overwrite").partitionBy("dossier").json(path)
