"""What grows with the input: plans and rows of the queries that were found to grow faster."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import substrings
from corpusloom.functions.vectors import cosine
from corpusloom.operators import concepts, content
from corpusloom.plans.queries import ORACLES, QUERIES
from corpusloom.sources import corpus


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_expressions_are_not_compared_with_every_text(spark):
    texts = spark.createDataFrame([("One été here",), ("an ÉTÉ, été",), ("",), (None,)], "text string")
    wanted = spark.createDataFrame([(" Été ",), ("here",), ("nothing",), ("",), (None,), ("named",)], "expression string")
    got = content.expression_status(wanted, spark.createDataFrame([("Named",)], "canonical_form string"), texts)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    rows = {r.expression: (r.status, r.n_texts) for r in got.collect()}
    assert rows == {" Été ": ("mentioned", 2), "here": ("mentioned", 1), "nothing": ("absent", 0), "": ("mentioned", 3), None: ("absent", 0), "named": ("treated", 0)}


def test_substrings_equal_a_plain_search(monkeypatch):
    rng = np.random.default_rng(3)
    for step in (7, 1 << 20):
        monkeypatch.setattr(substrings, "STEP", step)
        texts = ["".join(rng.choice(list("abé b"), rng.integers(0, 60))) for _ in range(30)] + [None, ""]
        strings = sorted({"".join(rng.choice(list("abé b"), rng.integers(0, 25))) for _ in range(80)} | {t[3:40] for t in texts if t})
        rows, index = substrings.Substrings(strings).held(pa.array(texts).slice(2))
        want = {(i, j) for i, t in enumerate(texts[2:]) if t is not None for j, s in enumerate(strings) if s in t}
        assert len(rows) == len(want) and set(zip(rows.tolist(), index.tolist())) == want


def test_nearest_equals_all_pairs_and_makes_none(spark):
    rng = np.random.default_rng(4)
    odd = [None, [], [1.0, 2.0], [0.0] * 3, [1.0, None, 1.0], [float("nan"), 1.0, 1.0], [1e-170, 1e-170, 0.0], [1e200, 1.0, 0.0]]
    rows = [(i, odd[i] if i < len(odd) else [float(x) for x in rng.integers(-2, 3, 3)], f"d{i % 3}") for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>, document_id string").repartition(3)
    new, known = vectors.filter("vec_id % 4 = 1"), vectors.filter("vec_id % 4 <> 1")
    got = concepts.nearest_concepts(new, known)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    pairs = new.selectExpr("vec_id AS new_id", "v AS nv", "document_id AS new_doc").crossJoin(known.selectExpr("vec_id AS known_id", "v AS kv", "document_id AS known_doc"))
    rank = F.row_number().over(Window.partitionBy("new_id").orderBy(F.desc("score"), "known_id"))
    want = pairs.withColumn("score", cosine("kv", "nv")).withColumn("rank", rank).filter("rank <= 3")
    names = ["new_id", "rank", "known_id", "new_doc", "known_doc", "score"]
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))


def test_tiles_meet_once_and_as_few_as_can_be(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 4))
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(90, None), (91, [0.0] * 4)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    assert vectors.count() * 4 * 8 < concepts.TILE_BYTES == 4 << 20
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(s >= 0.8)) if a < b}
    for tile in (4 << 20, 1000, 700, 300):
        monkeypatch.setattr(concepts, "TILE_BYTES", tile)
        monkeypatch.setattr(concepts, "ROWS", 7)
        got = concepts.similar_pairs(vectors, 0.8, 92).collect()
        assert len(got) == len(want) and {(r.a, r.b) for r in got} == want and all(r.score == s[r.a, r.b] for r in got)


def test_groups_need_few_links(spark):
    vectors = spark.createDataFrame([(i, [1.0, i % 2 * 1.0]) for i in range(40)], "vec_id long, v array<double>")
    links = concepts.similar_links(vectors, 0.9, 40)
    assert links.count() == 38 and concepts.similar_pairs(vectors, 0.9, 40).count() == 380
    groups = {r.node: r.component for r in concepts.merge_groups(links).collect()}
    assert groups == {i: i % 2 for i in range(40)}
    own = spark.createDataFrame([(5, 5), (1, 2), (2, 2)], "a long, b long")
    assert {(r.node, r.component) for r in concepts.merge_groups(own).collect()} == {(5, 5), (1, 1), (2, 1)}


def test_no_text_is_shuffled_to_its_label(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan(corpus.chunks(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


@pytest.mark.parametrize("name", ["snapshot_diff", "rechunk_mismatch", "migratable_documents"])
def test_chunk_ids_that_repeat(spark, tmp_path, name):
    """Every third document is of one source, so that a stretch of it holds several rows of one chunk id."""
    got, want = both_engines(spark, tmp_path, name)
    assert got == want


def test_results_whose_chunk_ids_repeat(spark, tmp_path):
    # SQL's any_value may take has_number from any row of a chunk id.
    got, want = both_engines(spark, tmp_path, "dossier_merge", ["has_number"])
    assert got == want
    got, want = both_engines(spark, tmp_path, "retrieval_coverage")
    assert got == want


def both_engines(spark, folder, name, without=()):
    db = duckdb.connect()
    db.execute(f"COPY (SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'src0' ELSE source END AS source) FROM '/root/testdata/sf0.001/documents.parquet') TO '{folder}/documents.parquet'")
    db.execute(f"COPY (FROM '/root/testdata/sf0.001/embeddings.parquet') TO '{folder}/embeddings.parquet'")
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, str(folder)).drop(*without)
    sql = db.sql(ORACLES[name])
    names = [c for c in sql.columns if c not in without]
    text = lambda rows: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)
    return text(map(tuple, df.select(names).collect())), text(sql.project(", ".join(names)).fetchall())
