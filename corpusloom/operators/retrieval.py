"""Hybrid retrieval: vector top-k, section expansion, concept expansion with re-scoring.

Every step is partitioned by query, so a batch of queries is one plan. A stated set of queries is
broadcast to the vectors, which are scanned once; text is attached last.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from ..plans.lineage import checkpoint, in_blocks, small_side

#: A set of queries of at most this many rows is broadcast; a larger one in blocks.
QUERY_ROWS = 10_000


@dataclass(frozen=True)
class Settings:
    top_k: int = 15
    max_sections: int = 3
    cap: int = 30
    margin: float = 0.20


def scored(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """``qid, chunk_id, score`` of every vector for every query (``qid, q, held_out``) but its held-out chunk."""
    both = reduce(DataFrame.unionByName, [vectors.crossJoin(block) for block in in_blocks(queries, "qid", QUERY_ROWS)])
    return both.filter(~F.col("chunk_id").eqNullSafe(F.col("held_out"))).select("qid", "chunk_id", cosine("v", "q").alias("score"))


def top_hits(scores: DataFrame, k: int) -> DataFrame:
    """``qid, chunk_id, score, rank``: score descending, then chunk id."""
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "chunk_id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k)


def search_stage(hits: DataFrame, meta: DataFrame) -> DataFrame:
    """Hits whose chunk exists and is not structural. Both kinds have used up their place in the top k."""
    return hits.join(meta, "chunk_id").filter(~F.col("structural")).select("qid", "chunk_id", "document_id", "trail", "score", "rank")


def seed_sections(search: DataFrame, most: int) -> DataFrame:
    """``qid, document_id, trail, seed``: the first distinct sections in hit order."""
    first = search.groupBy("qid", "document_id", "trail").agg(F.min("rank").alias("at"))
    return first.withColumn("seed", F.row_number().over(Window.partitionBy("qid").orderBy("at"))).filter(F.col("seed") <= most).drop("at")


def section_stage(seeds: DataFrame, meta: DataFrame, search: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All chunks of the seed sections, and those of them that are not hits already."""
    inside = meta.join(seeds, ["document_id", "trail"]).filter(~F.col("structural")).select("qid", "chunk_id", "chunk_index", "seed")
    return inside, inside.join(search.select("qid", "chunk_id"), ["qid", "chunk_id"], "left_anti")


def concept_candidates(inside: DataFrame, mentions: DataFrame, included: DataFrame) -> DataFrame:
    """``qid, chunk_id, concept_id, found``: chunks that share a concept with a seed section's chunk.

    Concepts are discovered by seed, chunk and name; a chunk keeps the concept that reached it first.
    """
    order = F.struct("seed", "chunk_index", "concept_id")
    concepts = inside.select("qid", "chunk_id", "chunk_index", "seed").join(mentions.select("chunk_id", "concept_id"), "chunk_id").groupBy("qid", "concept_id").agg(F.min(order).alias("found"))
    reached = concepts.join(mentions.select("chunk_id", "concept_id"), "concept_id").groupBy("qid", "chunk_id").agg(F.min("found").alias("found"))
    return reached.join(included, ["qid", "chunk_id"], "left_anti").withColumn("concept_id", F.col("found.concept_id"))


def scored_candidates(candidates: DataFrame, vectors: DataFrame, queries: DataFrame, meta: DataFrame) -> DataFrame:
    """Candidates with a vector and a chunk that is not structural, but a query's held-out chunk; only
    their own vectors are scored."""
    pairs = candidates.join(vectors.select("chunk_id", "v"), "chunk_id").join(small_side(queries, QUERY_ROWS), "qid")
    scores = pairs.filter(~F.col("chunk_id").eqNullSafe(F.col("held_out"))).withColumn("score", cosine("v", "q")).drop("v", "q", "held_out")
    return scores.join(meta.filter(~F.col("structural")).select("chunk_id"), "chunk_id")


def fill_slots(candidates: DataFrame, best: DataFrame, used: DataFrame, s: Settings) -> DataFrame:
    """Candidates at or above the floor (best hit less margin), best first, into the free places."""
    rows = candidates.join(best, "qid").filter(F.col("score") >= F.col("best") - F.lit(s.margin)).join(used, "qid")
    turn = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "found", "chunk_id"))
    return rows.withColumn("turn", turn).filter(F.col("turn") <= F.greatest(F.lit(0), F.lit(s.cap) - F.col("used")))


def retrieve(chunks: DataFrame, vectors: DataFrame, mentions: DataFrame | None, queries: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``qid, ord, chunk_id, score, reason`` in output order: hits, section chunks (score null), concept chunks.

    Without mentions the concept stage is left out. The cap cuts the whole list.
    """
    s = settings or Settings()
    meta = chunks.select("chunk_id", "document_id", "chunk_index", "trail", "structural")
    # What later steps read again and again is made once.
    search = checkpoint(search_stage(top_hits(scored(vectors, queries), s.top_k), meta))
    inside, section = section_stage(seed_sections(search, s.max_sections), meta, search)
    inside = checkpoint(inside)
    section = inside.join(search.select("qid", "chunk_id"), ["qid", "chunk_id"], "left_anti")
    none = F.lit(None)
    parts = [
        search.select("qid", F.lit(1).alias("stage"), F.col("rank").alias("a"), F.lit(0).alias("b"), "chunk_id", "score", F.lit("search").alias("reason")),
        section.select("qid", F.lit(2).alias("stage"), F.col("seed").alias("a"), F.col("chunk_index").alias("b"), "chunk_id", none.cast("double").alias("score"), F.lit("section").alias("reason")),
    ]
    included = search.select("qid", "chunk_id").unionByName(section.select("qid", "chunk_id"))
    if mentions is not None:
        best = search.groupBy("qid").agg(F.max("score").alias("best"))
        used = included.groupBy("qid").agg(F.count(F.lit(1)).alias("used"))
        candidates = checkpoint(concept_candidates(inside, checkpoint(mentions), included))
        found = scored_candidates(candidates, vectors, queries, meta)
        parts.append(fill_slots(found, best, used, s).select("qid", F.lit(3).alias("stage"), F.col("turn").alias("a"), F.lit(0).alias("b"), "chunk_id", "score", F.concat(F.lit("concept:"), "concept_id").alias("reason")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    place = F.row_number().over(Window.partitionBy("qid").orderBy("stage", "a", "b", "chunk_id")).cast("int")
    return rows.withColumn("ord", place).filter(F.col("ord") <= s.cap).select("qid", "ord", "chunk_id", "score", "reason")


def grouped(results: DataFrame, chunks: DataFrame) -> DataFrame:
    """Results by section, in the order sections first appear: ``qid, section_ord, document_id, trail,
    chunk_ids`` (by chunk index) and the distinct sorted reasons."""
    rows = results.join(chunks.select("chunk_id", "document_id", "trail", "chunk_index"), "chunk_id")
    groups = rows.groupBy("qid", "document_id", "trail").agg(
        F.min("ord").alias("first"),
        F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda x: x["chunk_id"]).alias("ids"),
        F.sort_array(F.collect_set("reason")).alias("reasons"),
    )
    turn = F.row_number().over(Window.partitionBy("qid").orderBy("first")).cast("int")
    return groups.select("qid", turn.alias("section_ord"), "document_id", "trail", F.array_join("ids", ",").alias("chunk_ids"), F.array_join("reasons", ",").alias("reasons"))


def merged(results: DataFrame) -> DataFrame:
    """Several queries' results as one list: each chunk once, with its best score and how many found it."""
    return results.groupBy("chunk_id").agg(F.max("score").alias("score"), F.count_distinct("qid").alias("n_queries"))


def stride_sample(rows: DataFrame, n: int, group: str = "document_id", key: str = "chunk_id", most: int = 15) -> DataFrame:
    """Every max(1, n // most)-th row by key, the first ``most`` of them; n is the number of rows.

    A key is its group, '::' and a rest, so a row's position is that of its group plus that within
    it. Groups are put in order by ranges, and only one total for each range meets in one task.
    """
    step = max(1, n // most)
    head = F.concat(F.col(group), F.lit("::"))
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    ranges = checkpoint(counts.withColumn("head", head).repartitionByRange("head").withColumn("range", F.spark_partition_id()))
    totals = ranges.groupBy("range").agg(F.sum("n").alias("all"))
    earlier = totals.select("range", (F.sum("all").over(Window.orderBy("range")) - F.col("all")).alias("earlier"))
    own = F.sum("n").over(Window.partitionBy("range").orderBy("head")) - F.col("n")
    before = ranges.withColumn("own", own).join(earlier, "range").select(group, (F.col("own") + F.col("earlier")).alias("before"))
    inside = F.row_number().over(Window.partitionBy(group).orderBy(key)) - 1
    placed = rows.withColumn("inside", inside).join(before, group).withColumn("position", F.col("before") + F.col("inside"))
    return placed.filter((F.col("position") % step == 0) & (F.col("position") < step * most)).drop("inside", "before")
