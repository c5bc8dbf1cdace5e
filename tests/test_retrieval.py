"""Hand-made corpora, one for each rule of retrieval."""

from pyspark.sql import functions as F

from corpusloom.operators import retrieval as r

CHUNK = "chunk_id string, document_id string, chunk_index int, trail string, structural boolean"
VECTOR = "chunk_id string, v array<double>"
QUERY = "qid long, held_out string, q array<double>"


def corpus(spark, rows):
    """rows: (chunk_id, trail, structural, angle cosine or None)"""
    chunks = [(c, c.split("::")[0], int(c.split("::")[1]), t, s) for c, t, s, _ in rows if t is not None]
    vectors = [(c, [x, (1 - x * x) ** 0.5]) for c, _, _, x in rows if x is not None]
    return spark.createDataFrame(chunks, CHUNK), spark.createDataFrame(vectors, VECTOR), spark.createDataFrame([(1, None, [1.0, 0.0])], QUERY)


def mentions(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, concept_id string")


def run(spark, rows, marks=None, **kw):
    c, v, q = corpus(spark, rows)
    out = r.retrieve(c, v, mentions(spark, marks) if marks else None, q, r.Settings(**kw)).orderBy("ord").collect()
    return [(x.chunk_id, x.score, x.reason) for x in out]


def test_structural_hit_uses_its_place(spark):
    rows = [("a::0", "T", False, 0.9), ("a::1", "Index", True, 0.8), ("a::2", "U", False, 0.7)]
    assert [x[0] for x in run(spark, rows, top_k=2, max_sections=0)] == ["a::0"]


def test_hit_outside_the_seeds_stays(spark):
    rows = [("a::0", "T", False, 0.9), ("b::0", "U", False, 0.8)]
    assert [x[0] for x in run(spark, rows, top_k=2, max_sections=1)] == ["a::0", "b::0"]


def test_large_section_crowds_out_concepts(spark):
    rows = [("a::0", "T", False, 0.9), *((f"a::{i}", "T", False, 0.0) for i in range(1, 6)), ("b::0", "U", False, 0.85)]
    out = run(spark, rows, [("a::0", "k"), ("b::0", "k")], top_k=1, cap=4)
    assert [x[0] for x in out] == ["a::0", "a::1", "a::2", "a::3"]
    assert [x[1] for x in out] == [0.9, None, None, None]


def test_floor_includes_equality(spark):
    rows = [("a::0", "T", False, 0.75), ("b::0", "U", False, 0.5), ("b::1", "V", False, 0.499999)]
    out = run(spark, rows, [("a::0", "k"), ("b::0", "k"), ("b::1", "k")], top_k=1, margin=0.25)
    assert [x[0] for x in out] == ["a::0", "b::0"]


def test_first_concept_is_the_reason(spark):
    rows = [("a::0", "T", False, 0.9), ("a::1", "T", False, 0.1), ("b::0", "U", False, 0.85)]
    out = run(spark, rows, [("a::0", "z"), ("a::1", "k"), ("b::0", "k"), ("b::0", "z")], top_k=1)
    assert out[-1] == ("b::0", 0.85, "concept:z")


def test_candidates_without_vector_chunk_or_prose_go(spark):
    rows = [("a::0", "T", False, 0.9), ("b::0", "U", False, None), ("b::1", None, False, 0.88), ("b::2", "Index", True, 0.88)]
    out = run(spark, rows, [(c, "k") for c in ("a::0", "b::0", "b::1", "b::2")], top_k=1)
    assert [x[0] for x in out] == ["a::0"]


def test_empty_corpus(spark):
    c, v, q = corpus(spark, [("a::0", "T", False, 0.9)])
    assert r.retrieve(c, v.limit(0), None, q).count() == 0
    assert r.retrieve(c, v.filter("false"), mentions(spark, [("a::0", "k")]), q).count() == 0


def test_margin_and_cap_are_monotone(spark):
    rows = [("a::0", "T", False, 0.9), *((f"b::{i}", "U", False, 0.9 - i / 50) for i in range(1, 12))]
    marks = [(c, "k") for c, *_ in rows]
    narrow, wide = (run(spark, rows, marks, top_k=1, margin=m) for m in (0.0, 0.2))
    assert set(narrow) <= set(wide)
    assert run(spark, rows, marks, top_k=1, cap=3) == run(spark, rows, marks, top_k=1, cap=8)[:3]


def test_stride_sample_matches_positions(spark):
    ids = sorted(f"src{d}::{i}" for d in range(12) for i in range(4))
    df = spark.createDataFrame([(x.split("::")[0], x) for x in ids], "document_id string, chunk_id string")
    got = [x.chunk_id for x in r.stride_sample(df, len(ids)).orderBy("position").collect()]
    step = max(1, len(ids) // 15)
    assert got == ids[::step][:15]


def test_grouped_keeps_first_appearance(spark):
    res = spark.createDataFrame([(1, 1, "b::1", 0.9, "search"), (1, 2, "a::0", 0.8, "search"), (1, 3, "b::0", None, "section")], "qid long, ord int, chunk_id string, score double, reason string")
    chunks = spark.createDataFrame([("a::0", "a", "T", 0), ("b::0", "b", "U", 0), ("b::1", "b", "U", 1)], "chunk_id string, document_id string, trail string, chunk_index int")
    got = [(x.section_ord, x.chunk_ids, x.reasons) for x in r.grouped(res, chunks).orderBy("section_ord").collect()]
    assert got == [(1, "b::0,b::1", "search,section"), (2, "a::0", "search")]
    assert r.merged(res).filter(F.col("n_queries") == 1).count() == 3
