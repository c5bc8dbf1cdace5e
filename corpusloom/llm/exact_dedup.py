"""Exact deduplication by 128-bit content hash, with byte comparison inside every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, checkpoint, small_side

def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_digits: int = 32) -> DataFrame:
    """Group documents whose texts are identical without white space; the fullest original stays.

    A group's survivor has the most code points in its original text, then the smallest id.
    Returns ``id_col, keep_id, group_size, kept, text_sha256``.

    The grouping key is the first half (128 bits, ``key_digits`` of hex) of the SHA-256 of the normalised text. Of a group of
    two or more, the least and the greatest text are then compared byte by byte; if they differ, the
    hash collides, and the group's members are regrouped under their own texts, so no collision merges
    texts. Only narrow rows (id, hash, length) are shuffled for the grouping; both steps aggregate
    partially, so a large group sends one row, or two texts, from each task.

    Null text counts as empty, and empty texts form one group like any other. A null id sorts after
    every other id. Repeated rows (same id, same normalised text, same length) are one document: they
    are returned once, and ``group_size`` counts each. An empty table gives an empty result. Other
    columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    normal = F.translate(text, SPACES, "")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.sha2(normal.cast("binary"), 256).alias("sha"),
        F.length(text).cast("long").alias("len"),
    )
    small = checkpoint(
        rows.groupBy("id", "sha", "len").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("key", F.substring("sha", 1, key_digits))
    )
    several = small.groupBy("key").agg(F.sum("copies").alias("n")).filter("n > 1").select("key")
    texts = docs.select(F.col(id_col).alias("id"), normal.alias("normal")).withColumn("full", F.sha2(F.col("normal").cast("binary"), 256)).withColumn("key", F.substring("full", 1, key_digits))
    bounds = texts.join(small_side(several, 80), "key", "left_semi").groupBy("key").agg(F.min("normal").alias("head"), F.max("normal").alias("tail"))
    collided = checkpoint(bounds.filter("head <> tail").select("key", "head"))
    keyed = small.withColumn("own", F.lit(None).cast("string"))
    if not collided.isEmpty():
        other = texts.join(collided, "key").filter("normal <> head").select(F.col("id").alias("c_id"), F.col("full").alias("c_sha"), F.col("normal").alias("own")).distinct()
        keyed = small.join(other, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("sha") == F.col("c_sha")), "left").select("id", "sha", "len", "copies", "key", "own")
    groups = keyed.groupBy("key", "own").agg(
        F.sum("copies").alias("group_size"),
        F.min(F.struct((-F.col("len")).alias("less"), F.col("id").isNull().alias("none"), "id")).alias("best"),
    ).select(F.col("key").alias("g_key"), F.col("own").alias("g_own"), "group_size", F.col("best.id").alias("keep_id"))
    joined = keyed.join(groups, (F.col("key") == F.col("g_key")) & F.col("own").eqNullSafe(F.col("g_own")))
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
