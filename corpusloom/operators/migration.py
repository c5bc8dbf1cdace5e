"""A metadata migration from plan to swap: only what re-chunking proves, verified before it is swapped in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import replace_table
from .catalog import migratable, rechunk_mismatch, results_diff, snapshot_diff


def plan(stored: DataFrame, fresh: DataFrame, flags: list[str]) -> DataFrame:
    """``chunk_id, wanted``: the new flags (map of strings) of every chunk of the documents whose stored
    chunks (``document_id, pos, ...``) equal the fresh ones; a document with one mismatch is left out."""
    whole = migratable(stored, rechunk_mismatch(stored, fresh))
    entries = [x for c in flags for x in (F.lit(c), F.col(c).cast("string"))]
    return fresh.join(whole, "document_id", "left_semi").select("chunk_id", F.create_map(*entries).alias("wanted")).dropDuplicates(["chunk_id"])


def updated(vectors: DataFrame, planned: DataFrame) -> DataFrame:
    """The snapshot (``chunk_id, document, embedding, metadata``) with the planned keys set; all else stays."""
    rows = vectors.join(planned, "chunk_id", "left")
    kept = F.map_filter("metadata", lambda k, _: ~F.coalesce(F.array_contains(F.map_keys("wanted"), k), F.lit(False)))
    return rows.withColumn("metadata", F.when(F.col("wanted").isNull(), F.col("metadata")).otherwise(F.map_concat(kept, "wanted"))).drop("wanted")


def migrate(vectors: DataFrame, stored: DataFrame, fresh: DataFrame, flags: list[str], target: str, results: Callable[[DataFrame], DataFrame] | None = None, apply: bool = False) -> DataFrame:
    """Plan, stage, verify and swap: returns the plan; writes only with ``apply``.

    The staged table must hold the old one's ids, documents, vectors and metadata, every planned value
    and no other new key; and ``results`` (``qid, ids`` of a snapshot) must be the same before and after.
    A problem raises, and nothing is swapped.
    """
    planned = plan(stored, fresh, flags)

    def problems(after: DataFrame) -> DataFrame:
        found = snapshot_diff(vectors, after, flags, expected=planned).select(F.col("chunk_id").alias("id"), "problem")
        if results is None:
            return found
        return found.unionByName(results_diff(results(vectors), results(after)).select(F.col("qid").cast("string").alias("id"), "problem"))

    replace_table(updated(vectors, planned), target, verify=lambda after: problems(after).orderBy("id", "problem"), apply=apply)
    return planned
