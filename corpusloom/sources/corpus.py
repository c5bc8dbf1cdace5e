"""The corpus model: readers of its files, and views of it over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.vectors import doubles
from ..llm.common import small_side

CHUNK_JSON = "array<struct<index:int,text:string,heading_trail:array<string>,token_count:int,embed_text:string,has_code:boolean,has_formula:boolean,has_image:boolean>>"
STATUS = T.MapType(T.StringType(), T.StructType([T.StructField("status", T.StringType())]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- Files ---------------------------------------------------------------------------------------


def read_chunk_files(spark: SparkSession, glob: str) -> DataFrame:
    """chunks.json files, one array per document folder: ``document_id, pos, index, text, ...``.

    An index that occurs twice in a file keeps its last record, in the place of its first.
    A missing path is an error.
    """
    files = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("document_id"), F.from_json("value", CHUNK_JSON).alias("chunks"))
    rows = files.select("document_id", F.posexplode("chunks").alias("pos", "c")).select("document_id", "pos", "c.*")
    return last_wins(rows)


def last_wins(rows: DataFrame) -> DataFrame:
    """Of rows of equal (document_id, index): the last by pos, at the least pos."""
    cols = [c for c in rows.columns if c not in ("document_id", "index", "pos")]
    out = rows.groupBy("document_id", "index").agg(F.min("pos").alias("pos"), F.max_by(F.struct(*cols), "pos").alias("c"))
    return out.select("document_id", "pos", "index", "c.*")


def read_markdown(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("document_id"), F.col("value").alias("pivot_md"))


def read_status_files(spark: SparkSession, glob: str) -> DataFrame:
    """status.json files as ``document_id, step, status``; malformed files and steps that are no objects are skipped."""
    files = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("document_id"), "value")
    return parse_status(files)


def parse_status(files: DataFrame) -> DataFrame:
    """``document_id, value`` (JSON) to ``document_id, step, status``."""
    steps = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    rows = files.select("document_id", F.explode(steps).alias("step", "body"))
    return rows.select("document_id", "step", F.get_json_object("body", "$.status").alias("status")).filter(F.col("status").isNotNull())


def list_files(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """Files of a folder by a case-insensitive suffix: ``path, name, length``. Contents are not read."""
    rows = spark.read.format("binaryFile").load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    return rows.filter(F.lower("name").endswith(suffix.lower())).orderBy("name")


def documents_with(files: DataFrame, *names: str) -> DataFrame:
    """Documents (folders of the listed ``path``) that hold a file of each name: ``document_id``."""
    parts = F.split("path", "/")
    rows = files.select(F.element_at(parts, -2).alias("document_id"), F.element_at(parts, -1).alias("name")).filter(F.col("name").isin(list(names)))
    return rows.groupBy("document_id").agg(F.count_distinct("name").alias("n")).filter(F.col("n") == len(set(names))).select("document_id")


# ---- Views over the test tables --------------------------------------------------------------------


#: Bytes of a vector's id and label in a broadcast.
LABEL_BYTES = 40


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have a vector, as chunks of the document named by their source. Ids and labels go to the
    documents, so that no text is shuffled, while they are counted to fit a broadcast."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    e = small_side(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label"), LABEL_BYTES)
    i = F.col("doc_id")
    image = F.concat(F.lit("\n![fig "), i.cast("string"), F.lit("](images/d"), i.cast("string"), F.lit(".png)"))
    text = F.when(i % 3 == 0, F.concat("text", image)).otherwise(F.col("text"))
    title = F.when(F.col("label") == 9, "Sommaire").otherwise(F.concat(F.lit("S"), F.expr("label div 4").cast("string")))
    index = F.expr("doc_id div 20").cast("int")
    rows = d.join(e, "doc_id").select(
        "doc_id",
        F.col("source").alias("document_id"),
        index.alias("chunk_index"),
        F.array("lang", title).alias("heading_trail"),
        text.alias("text"),
        F.when(i % 11 != 0, i % 7 == 0).alias("has_code"),
        F.when(i % 11 != 0, i % 5 == 0).alias("has_formula"),
    )
    return rows.withColumns({
        "chunk_id": tx.chunk_key(F.col("document_id"), F.col("chunk_index")),
        "trail": tx.breadcrumb("heading_trail"),
        "has_image": tx.has_image("text"),
        "structural": tx.is_structural("heading_trail"),
    })


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chunk_id, vec_id, v`` of the chunks."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), doubles("embedding").alias("v"))
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return d.join(e, "doc_id").select(tx.chunk_key(F.col("source"), F.expr("doc_id div 20")).alias("chunk_id"), F.col("doc_id").alias("vec_id"), "v")


def mentions(chunk_rows: DataFrame, least: int = 2, most: int = 12, per_chunk: int = 8) -> DataFrame:
    """``chunk_id, document_id, chunk_index, concept_id``: per chunk up to ``per_chunk`` words of five letters
    or more that ``least`` to ``most`` chunks hold, the commonest first."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{5,}"), 0)))
    rows = chunk_rows.select("chunk_id", "document_id", "chunk_index", word.alias("concept_id"))
    df = rows.groupBy("concept_id").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df").between(least, most))
    turn = F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("df"), "concept_id"))
    return rows.join(df, "concept_id").withColumn("turn", turn).filter(F.col("turn") <= per_chunk).select("chunk_id", "document_id", "chunk_index", "concept_id")
