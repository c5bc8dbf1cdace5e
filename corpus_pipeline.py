"""From raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a frame
that is written as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

import posixpath
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import checkpoint, shared_folder, shrink, small_side, table
from corpusloom.llm.exact_dedup import exact_dedup
from corpusloom.llm.language_crf import UNDETERMINED, identify, train
from corpusloom.llm.minhash_dedup import near_duplicates
from corpusloom.llm.packing import pack
from corpusloom.llm.queries import held_out
from corpusloom.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_row_ids(docs: DataFrame) -> DataFrame:
    """docs with ``row_id``, a long that tells rows apart: doc_id where every row has its own.

    Where an id is null or shared, row_id is the place of (doc_id, text digest) in ascending order, null
    ids last; then only repeated rows (same id, same text) share one. The ids are sorted without texts.
    """
    docs = docs.select(*COLUMNS)
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        return docs.withColumn("row_id", F.col("doc_id"))
    digest = F.when(F.col("text").isNull(), F.lit("")).otherwise(F.sha2(F.col("text").cast("binary"), 256))
    key = [F.col("doc_id").isNull().alias("k_none"), F.coalesce("doc_id", F.lit(0)).alias("k_id"), digest.alias("k_text")]
    order = ["k_none", "k_id", "k_text"]
    numbers = checkpoint(docs.select(*key).distinct().orderBy(*order).withColumn("row_id", F.monotonically_increasing_id()))
    return docs.select("*", *key).join(numbers, order).drop(*order)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows of the dropped row_ids; the texts move only if these are too many to broadcast.

    The ids are made once and checkpointed, for they are counted and then joined.
    """
    return docs.join(small_side(checkpoint(dropped.select("row_id").distinct()), 24), "row_id", "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: those without a letter, null and empty texts among them. Mixed
    text is clean, in however many languages. Each row is judged by its own text, whatever its id."""
    model = train(docs.filter(~held_out()))
    docs = _with_row_ids(docs)
    found = identify(docs, model, id_col="row_id")
    return _without(docs, found.filter(F.col("lang_pred") == UNDETERMINED))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of texts that are equal without white space (the fullest, then the
    smallest id), and one of repeated rows. Null and empty texts are one group. Different texts of one id
    are documents of their own, as are those of a null id, which stands after all others. An empty table
    stays empty; extra columns go."""
    shrink(spark)
    docs = _with_row_ids(docs)
    found = checkpoint(exact_dedup(docs, id_col="row_id").select("row_id", "kept"))
    if found.count() < docs.count():
        docs = docs.dropDuplicates(["row_id"])
    return _without(docs, found.filter(~F.col("kept")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near-duplicates (80 % of shingles of five words, chained).
    Documents without words link with none and stay. Null and shared ids as for copies; repeated rows go
    or stay together. An empty table stays empty; extra columns go."""
    shrink(spark)
    docs = _with_row_ids(docs)
    return _without(docs, near_duplicates(docs, id_col="row_id").filter(~F.col("kept")))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out of each text what a smaller document holds too; whole characters go. Every document
    stays, an emptied one with an empty text."""
    shrink(spark)
    done = remove_repeats(docs, carry=("lang", "source"), whole_chars=True)
    text = F.decode("kept", "UTF-8")
    return done.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences, a row per piece: null and empty texts are one token, long texts
    several pieces, repeated rows and null ids are packed as they come. An empty table gives no rows."""
    shrink(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("minhash_dedup", near_copies),
    ("suffix_dedup", passages),
    ("best_fit_packing", packing),
]

#: SQL can't express the language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Their results go to the folder in spark.checkpoint.dir; each but the
    last is deleted when its successor is written."""
    folder = posixpath.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = posixpath.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, True)
        before = path
    return docs
