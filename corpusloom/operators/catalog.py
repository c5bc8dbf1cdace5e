"""Index status, snapshots, and verified metadata migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug_of


def done_documents(status: DataFrame, step: str) -> DataFrame:
    """Documents whose step is done; ``status`` has a row per document and step."""
    return status.filter((F.col("step") == step) & (F.col("status") == "done")).select("document_id").distinct()


def index_status(files: DataFrame, indexed: DataFrame) -> DataFrame:
    """Each file (``name, document_id``) is indexed or not_indexed."""
    known = indexed.select("document_id").distinct().withColumn("hit", F.lit(True))
    return files.join(known, "document_id", "left").select("name", "document_id", F.when(F.col("hit"), "indexed").otherwise("not_indexed").alias("state"))


def index_status_versioned(files: DataFrame, indexed: DataFrame) -> DataFrame:
    """As above, but a file whose slug is indexed under another content hash is modified."""
    slugs = indexed.select(slug_of("document_id").alias("slug"), F.lit(True).alias("same_slug")).distinct()
    known = indexed.select("document_id").distinct().withColumn("hit", F.lit(True))
    rows = files.join(known, "document_id", "left").withColumn("slug", slug_of("document_id")).join(slugs, "slug", "left")
    return rows.select("name", "document_id", F.when(F.col("hit"), "indexed").when(F.col("same_slug"), "modified").otherwise("not_indexed").alias("state"))


def index_totals(states: DataFrame) -> DataFrame:
    return states.agg(F.count(F.lit(1)).alias("present"), F.count_if(F.col("state") == "indexed").alias("indexed"), F.count_if(F.col("state") != "indexed").alias("not_indexed"))


def snapshot_diff(before: DataFrame, after: DataFrame, new_keys: list[str], key: str = "chunk_id", expected: DataFrame | None = None) -> DataFrame:
    """Problems between two snapshots (``key, document, embedding, metadata`` map): one row each.

    missing, added, document, embedding, changed:<metadata key>, unexpected:<metadata key>; and, for the
    new values that ``expected`` (``key, wanted`` map, one row a key) plans, expected:<metadata key>
    where the row after does not hold them.
    """
    b, a = before.alias("b"), after.alias("a")
    rows = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer")
    if expected is not None:
        plan = expected.select(F.col(key).alias("planned"), "wanted")
        rows = rows.join(plan, F.col(f"b.{key}") == F.col("planned"), "left")
    else:
        rows = rows.withColumn("wanted", F.lit(None).cast("map<string,string>"))
    both = F.col(f"b.{key}").isNotNull() & F.col(f"a.{key}").isNotNull()
    old, new = F.col("b.metadata"), F.col("a.metadata")
    changed = F.filter(F.map_keys(old), lambda k: ~F.try_element_at(old, k).eqNullSafe(F.try_element_at(new, k)))
    extra = F.array_except(F.map_keys(new), F.array_union(F.map_keys(old), F.array(*(F.lit(k) for k in new_keys))))
    wanted = F.col("wanted")
    unmet = F.filter(F.map_keys(wanted), lambda k: ~F.try_element_at(wanted, k).eqNullSafe(F.try_element_at(new, k)))
    problems = F.concat(
        F.array(
            F.when(F.col(f"a.{key}").isNull(), F.lit("missing")),
            F.when(F.col(f"b.{key}").isNull(), F.lit("added")),
            F.when(both & ~F.col("b.document").eqNullSafe(F.col("a.document")), F.lit("document")),
            F.when(both & ~F.col("b.embedding").eqNullSafe(F.col("a.embedding")), F.lit("embedding")),
        ),
        F.when(both, F.transform(changed, lambda k: F.concat(F.lit("changed:"), k))).otherwise(F.array().cast("array<string>")),
        F.when(both, F.transform(extra, lambda k: F.concat(F.lit("unexpected:"), k))).otherwise(F.array().cast("array<string>")),
        F.when(both & F.col("wanted").isNotNull(), F.transform(unmet, lambda k: F.concat(F.lit("expected:"), k))).otherwise(F.array().cast("array<string>")),
    )
    return rows.select(F.coalesce(F.col(f"b.{key}"), F.col(f"a.{key}")).alias(key), F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("problem"))


def results_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Queries whose result list (``qid, ids``) is not the same before and after: ``qid, problem``."""
    rows = before.select("qid", F.col("ids").alias("old")).join(after.select("qid", F.col("ids").alias("new")), "qid", "full_outer")
    return rows.filter(~F.col("old").eqNullSafe(F.col("new"))).select("qid", F.lit("results").alias("problem"))


#: The fields of a stored chunk that a fresh one must repeat.
FIELDS = ["index", "text", "heading_trail", "token_count", "embed_text", "has_code", "has_formula"]


def rechunk_mismatch(stored: DataFrame, fresh: DataFrame, fields: list[str] | None = None, keys: tuple[str, ...] = ("document_id", "pos")) -> DataFrame:
    """Compare chunks by (document_id, pos): ``document_id, pos, field`` for each difference, or 'count'. Where
    positions repeat, further keys tell the rows apart; without them each meets each."""
    fields = [c for c in (fields or FIELDS) if c in stored.columns]
    rows = stored.alias("s").join(fresh.alias("f"), list(keys), "full_outer")
    one_side = F.col(f"s.{fields[0]}").isNull() != F.col(f"f.{fields[0]}").isNull()
    diffs = F.array(*(F.when(~F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")), F.lit(c)) for c in fields))
    return rows.select("document_id", "pos", F.explode(F.when(one_side, F.array(F.lit("count"))).otherwise(F.filter(diffs, lambda x: x.isNotNull()))).alias("field"))


def migratable(stored: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Documents that one mismatch does not exclude as a whole."""
    return stored.select("document_id").distinct().join(mismatches.select("document_id").distinct(), "document_id", "left_anti")


def metadata_update(vectors: DataFrame, expected: DataFrame, column: str = "has_image") -> DataFrame:
    """Set a metadata column for the covered ids, and leave others as they are: ``chunk_id, column, covered``."""
    rows = vectors.join(expected.groupBy("chunk_id").agg(F.max(column).alias("new")), "chunk_id", "left")
    return rows.withColumn("covered", F.col("new").isNotNull()).withColumn(column, F.coalesce("new", column)).drop("new")


def pipeline_todo(steps: DataFrame, documents: DataFrame, status: DataFrame, start: int = 0, force: bool = False) -> DataFrame:
    """Steps (``ord, step``) to run for each document: from ``start`` on, those not done, or all by force."""
    done = status.filter("status = 'done'").select("document_id", "step", F.lit(True).alias("done"))
    rows = documents.crossJoin(F.broadcast(steps.filter(F.col("ord") >= start))).join(done, ["document_id", "step"], "left")
    return rows.filter(F.lit(force) | F.col("done").isNull()).select("document_id", "ord", "step")
