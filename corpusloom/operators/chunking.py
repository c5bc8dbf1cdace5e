"""Markdown blocks, greedy chunks with overlap, and length statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx


def block_kind(text) -> Column:
    first = F.ltrim(F.col(text))
    return (
        F.when(first.rlike(r"^#{1,6} "), "heading").when(first.startswith("```"), "code").when(first.rlike(r"^!\["), "image").when(first.startswith("$$"), "formula").otherwise("prose")
    )


def split_blocks(docs: DataFrame, id_col: str = "document_id", text_col: str = "pivot_md") -> DataFrame:
    """``id_col, block_index, kind, text``: code and formula fences stay whole; other text splits at blank
    lines, and a heading line stands alone.

    Fences and headings are found by one pattern that extracts blocks, so nothing inside a fence splits.
    """
    pattern = r"(?s)```.*?(?:```|\z)|\$\$.*?(?:\$\$|\z)|(?m:^#{1,6} [^\n]*$)|(?:(?!```|\$\$|\n\s*\n|\n#{1,6} ).)++"
    rows = docs.select(id_col, F.posexplode(F.filter(F.regexp_extract_all(text_col, F.lit(pattern), 0), lambda b: F.length(F.trim(F.regexp_replace(b, r"\s+", " "))) > 0)).alias("block_index", "raw"))
    clean = F.regexp_replace("raw", r"^\s+|\s+$", "")
    return rows.select(id_col, "block_index", clean.alias("text")).withColumn("kind", block_kind("text")).select(id_col, "block_index", "kind", "text")


def merge_descriptions(blocks: DataFrame, id_col: str = "document_id") -> DataFrame:
    """A code, formula or image block takes the prose block right after it, if that describes it
    (starts with 'Description:'), into ``embed_text``; the prose block goes."""
    w = Window.partitionBy(id_col).orderBy("block_index")
    special = ["code", "formula", "image"]
    rows = blocks.withColumns({"next_kind": F.lead("kind").over(w), "next_text": F.lead("text").over(w), "prev_kind": F.lag("kind").over(w)})
    describes = lambda t: F.startswith(t, F.lit("Description:"))
    takes = F.col("kind").isin(special) & (F.col("next_kind") == "prose") & describes(F.col("next_text"))
    taken = (F.col("kind") == "prose") & describes(F.col("text")) & F.col("prev_kind").isin(special)
    return rows.filter(~F.coalesce(taken, F.lit(False))).select(id_col, "block_index", "kind", "text", F.when(takes, F.concat_ws("\n", "text", "next_text")).alias("embed_text"))


def content_blocks(blocks: DataFrame) -> DataFrame:
    """Without headings and blanks; ``body`` is embed_text or text."""
    content = tx.body() if "embed_text" in blocks.columns else F.col("text")
    return blocks.filter(F.col("kind") != "heading").withColumn("body", content).filter(F.length(F.trim(F.regexp_replace("body", r"\s+", " "))) > 0)


def without_structural(blocks: DataFrame, trail: str = "heading_trail") -> DataFrame:
    """Blocks of sections that hold no content of their own (contents, index and the like) make no chunk."""
    return blocks.filter(~tx.is_structural(trail))


def line_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Non-blank lines as blocks: ``id_col, block_index, kind, text, n_tokens``."""
    lines = docs.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("block_index", "text")).filter(F.length(F.trim("text")) > 0)
    kind = F.when(F.col("text").contains(" | "), "table").when(F.col("text").rlike(r"[$#%&*]{3}"), "noise").otherwise("prose")
    return lines.select(id_col, "block_index", kind.alias("kind"), "text", F.size(F.regexp_extract_all("text", F.lit(r"\S+"), 0)).alias("n_tokens"))


def _chunk_numbers(n: np.ndarray, target: int) -> np.ndarray:
    """The chunk of each block of n tokens: from a chunk's start, a running sum gives its end at once."""
    total = np.concatenate([[0], np.cumsum(n)])
    solid = np.append(np.flatnonzero(n), len(n))
    chunk, start, number = np.empty(len(n), np.int32), 0, 0
    while start < len(n):
        first = solid[np.searchsorted(solid, start)]
        end = max(first + 1, int(np.searchsorted(total, total[start] + target, side="right")) - 1)
        chunk[start:end] = number
        start, number = end, number + 1
    return chunk


def greedy_chunks(blocks: DataFrame, target: int = 400, id_col: str = "doc_id") -> DataFrame:
    """Give each block the number of its chunk: a chunk closes before the block that would take it
    past target; a longer block is a chunk of its own. An unknown length counts as 0.

    A chunk's end depends on its start, so a document's lengths (numbers only) meet in one row.
    """
    block = F.struct("block_index", F.coalesce("n_tokens", F.lit(0)).alias("n"))
    docs = blocks.groupBy(id_col).agg(F.array_sort(F.collect_list(block)).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            n = flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            chunk = np.concatenate([_chunk_numbers(x, target) for x in np.split(n, np.cumsum(sizes)[:-1])])
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.RecordBatch.from_arrays([ids, flat.field("block_index"), pa.array(chunk), flat.field("n")], names=[id_col, "block_index", "chunk_index", "n_tokens"])

    types = {f.name: f.dataType for f in blocks.schema}
    names = [id_col, "block_index", "chunk_index", "n_tokens"]
    return docs.select(id_col, "b").mapInArrow(run, T.StructType([T.StructField(c, types[c] if c != "chunk_index" else T.IntegerType()) for c in names]))


def with_overlap(assigned: DataFrame, overlap: int = 1, id_col: str = "doc_id") -> DataFrame:
    """Each chunk's own blocks and the last ``overlap`` blocks of the chunk before it (``carried``)."""
    w = Window.partitionBy(id_col, "chunk_index").orderBy(F.desc("block_index"))
    carried = assigned.withColumn("from_end", F.row_number().over(w)).filter(F.col("from_end") <= overlap).drop("from_end").withColumn("chunk_index", F.col("chunk_index") + 1)
    exists = assigned.select(id_col, "chunk_index").distinct()
    return assigned.withColumn("carried", F.lit(False)).unionByName(carried.join(exists, [id_col, "chunk_index"], "left_semi").withColumn("carried", F.lit(True)))


#: Candidate embedding models and their input limits.
MODELS = [
    ("paraphrase-multilingual-MiniLM-L12-v2", "sentence-transformers/paraphrase-multilingual-MiniLM-L12-v2", 128),
    ("paraphrase-multilingual-mpnet-base-v2", "sentence-transformers/paraphrase-multilingual-mpnet-base-v2", 128),
    ("multilingual-e5-base", "intfloat/multilingual-e5-base", 512),
    ("multilingual-e5-large", "intfloat/multilingual-e5-large", 512),
    ("bge-m3", "BAAI/bge-m3", 8192),
    ("gte-multilingual-base", "Alibaba-NLP/gte-multilingual-base", 8192),
]


def model_limits(models: DataFrame, configs: DataFrame) -> DataFrame:
    """Each model's limit and where it is from: its JSON config (``name, config``; ``config``), or the listed one,
    as the config lacks the key (``no_key``) or there is none (``no_config``)."""
    own = F.get_json_object("config", "$.max_seq_length").cast("int")
    source = F.when(own.isNotNull(), "config").when(F.col("config").isNotNull(), "no_key").otherwise("no_config")
    return models.join(configs, "name", "left").select("name", F.coalesce(own, "max_tokens").alias("max_tokens"), source.alias("provenance"))


def length_stats(lengths: DataFrame, limits: DataFrame, *keys: str) -> DataFrame:
    """n, mean, largest, how many over each model's limit (strictly), and their percentage.

    Lengths are counted once; only the distinct ones meet the models. Without keys, every model has a
    row: of no lengths, n and n_over are 0 and the others null.
    """
    counts = lengths.groupBy(*keys, "n_tokens").agg(F.count(F.lit(1)).alias("c"))
    few = limits.select("name", "max_tokens")
    over = F.sum(F.when(F.col("n_tokens") > F.col("max_tokens"), F.col("c")).otherwise(0))
    n = F.sum("c")
    stats = counts.crossJoin(F.broadcast(few)).groupBy("name", *keys).agg(
        n.alias("n"), F.round(F.sum(F.col("n_tokens").cast("long") * F.col("c")) / F.sum(F.when(F.col("n_tokens").isNotNull(), F.col("c"))), 6).alias("mean_tokens"),
        F.max("n_tokens").alias("max_tokens_seen"), over.alias("n_over"), F.round(100.0 * over / n, 6).alias("pct_over"),
    )
    if keys:
        return stats
    return few.select("name").join(stats, "name", "left").fillna(0, ["n", "n_over"])
