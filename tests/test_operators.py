"""Small cases of the other operators, and the files they read and write."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.operators import catalog, chunking, concepts
from corpusloom.plans.lineage import in_blocks
from corpusloom.sources import corpus, sinks


def test_reference_bands(spark):
    new = [(1, [1.0, 0.0], "d1"), (2, [0.0, 1.0], "d1"), (3, [0.93, (1 - 0.93**2) ** 0.5], "d2")]
    known = [(10, [1.0, 0.0], "d1"), (11, [0.85, -((1 - 0.85**2) ** 0.5)], "d9")]
    schema = "vec_id long, v array<double>, document_id string"
    got = {r.new_id: r.verdict for r in concepts.resolution(concepts.nearest_concepts(spark.createDataFrame(new, schema), spark.createDataFrame(known, schema))).collect()}
    assert got == {1: "merge", 2: "new", 3: "arbitrate"}


def test_reference_pair_threshold(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.79, (1 - 0.79**2) ** 0.5])]
    got = concepts.similar_pairs(spark.createDataFrame(rows, "vec_id long, v array<double>"), 0.8, 3).collect()
    assert {(r.a, r.b) for r in got} == {(1, 2), (2, 3)}


def test_cyclic_pairs_are_one_group(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (7, 8)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in concepts.merge_groups(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {got[1], got[2], got[3]} == {1} and got[8] == 7 and got[140] == 100


def test_rename_guards(spark):
    c = spark.createDataFrame([("abc", "Old", ["Old", "New"]), ("abd", "Same", ["Same"])], "concept_id string, canonical_form string, aliases array<string>")
    wishes = [("abc", "New"), ("abd", "Same"), ("abd", "Stranger"), ("zzz", "x")]
    plan = concepts.rename_plan(c, spark.createDataFrame(wishes, "concept_id string, new_name string"))
    assert {(r.concept_id, r.new_name): (r.verdict, r.code) for r in plan.collect()} == {("abc", "New"): ("rename", 0), ("abd", "Same"): ("same", 0), ("abd", "Stranger"): ("not_an_alias", 1), ("zzz", "x"): ("unknown", 1)}
    after = concepts.apply_renames(c, plan)
    assert concepts.rename_problems(c, after, plan).count() == 0
    assert concepts.rename_problems(c, after.withColumn("aliases", F.array(F.lit("x"))), plan).count() == 2


def test_resolve_prefers_the_exact_id(spark):
    c = spark.createDataFrame([("ab",), ("abc",), ("xyz",)], "concept_id string")
    got = {r.wanted: (r.kind, r.concept_id) for r in concepts.resolve_id(c, spark.createDataFrame([("ab",), ("abc",), ("a",), ("x",), ("q",)], "wanted string")).collect()}
    assert got == {"ab": ("exact", "ab"), "abc": ("exact", "abc"), "a": ("ambiguous", None), "x": ("unique", "xyz"), "q": ("none", None)}


def test_chunk_files(spark, tmp_path):
    folder = tmp_path / "doc1"
    folder.mkdir()
    rows = [{"index": 0, "text": "a", "heading_trail": ["H"]}, {"index": 1, "text": "b"}, {"index": 0, "text": "c"}]
    (folder / "chunks.json").write_text(json.dumps(rows))
    got = [(r["pos"], r["index"], r["text"], r["has_code"]) for r in corpus.read_chunk_files(spark, f"{tmp_path}/*/chunks.json").orderBy("pos").collect()]
    assert got == [(0, 0, "c", None), (1, 1, "b", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        corpus.read_chunk_files(spark, f"{tmp_path}/none/chunks.json")


def test_status_files_skip_what_is_malformed(spark, tmp_path):
    for name, body in {"a": '{"index": {"status": "done"}}', "b": "{broken", "c": '{"index": "done"}', "d": "[]"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "status.json").write_text(body)
    got = catalog.done_documents(corpus.read_status_files(spark, f"{tmp_path}/*/status.json"), "index").collect()
    assert [r.document_id for r in got] == ["a"]


def test_listing_is_case_insensitive(spark, tmp_path):
    for name in ("b.PDF", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in corpus.list_files(spark, str(tmp_path)).collect()] == ["a.pdf", "b.PDF"]


def test_scalar_edges(spark):
    df = spark.createDataFrame([(None, "", "a___b"), (["A", "B"], "e", "a__b__c")], "heading_trail array<string>, embed_text string, document_id string").withColumn("text", F.lit("t"))
    got = df.select(tx.titled().alias("t"), tx.embedding_text("heading_trail", tx.body()).alias("e"), tx.slug_of().alias("s"), tx.is_structural().alias("x")).collect()
    assert [tuple(r) for r in got] == [("(sans titre)", "t", "a_", False), ("A > B", "A > B\n\ne", "a__b", False)]
    long = spark.createDataFrame([("x " * 200,), ("a \n b",)], "text string").select(tx.preview().alias("p")).collect()
    assert long[0].p.endswith("x...") and long[1].p == "a b"
    assert spark.range(1).select(tx.sorted_ints(F.lit("20,5, 5")).alias("k")).first().k == [5, 5, 20]


def test_markdown_fences_stay_whole(spark):
    md = "# T\n\nIntro\n\n```\na\n\n# b\n```\nDescription: code\n\n$$\nx\n$$"
    blocks = chunking.split_blocks(spark.createDataFrame([("d", md)], "document_id string, pivot_md string"))
    assert [r.kind for r in blocks.orderBy("block_index").collect()] == ["heading", "prose", "code", "prose", "formula"]
    merged = chunking.merge_descriptions(blocks).orderBy("block_index").collect()
    assert [r.kind for r in merged] == ["heading", "prose", "code", "formula"]
    assert merged[2].embed_text.endswith("Description: code")


def test_one_mismatch_excludes_the_document(spark):
    schema = "document_id string, pos int, text string"
    old = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, None)], schema)
    new = spark.createDataFrame([("a", 0, "x"), ("a", 1, "z"), ("b", 0, None)], schema)
    bad = catalog.rechunk_mismatch(old, new, ["text"])
    assert [tuple(r) for r in bad.collect()] == [("a", 1, "text")]
    assert [r.document_id for r in catalog.migratable(old, bad).collect()] == ["b"]


def test_replace_is_dry_verified_and_backed_up(spark, tmp_path):
    target = f"{tmp_path}/t"
    spark.range(3).write.parquet(target)
    plan = spark.range(5).toDF("id")
    assert sinks.replace_table(plan, target).count() == 5 and spark.read.parquet(target).count() == 3
    with pytest.raises(sinks.VerificationError):
        sinks.replace_table(plan, target, verify=lambda df: df.filter("id > 3"), apply=True)
    assert spark.read.parquet(target).count() == 3
    sinks.replace_table(plan, target, verify=lambda df: df.filter("id > 9"), apply=True)
    assert spark.read.parquet(target).count() == 5
    assert len([p for p in tmp_path.iterdir() if ".backup_" in p.name]) == 1


def test_stream_equals_table(spark, tmp_path):
    from corpusloom.streaming import events as ev

    rows = [(1, "2024-01-01 00:10:00", "a", 1.0), (1, "2024-01-01 00:20:00", "a", 2.0), (2, "2024-01-01 01:10:00", "b", 3.0)]
    df = spark.createDataFrame(rows, "user_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/in")
    got = []
    stream = ev.tumbling(ev.read_events(spark, f"{tmp_path}/in", df.schema))
    q = stream.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/ck").foreachBatch(lambda b, _: got.extend(b.collect())).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, got)) == sorted(map(tuple, ev.tumbling(df).collect()))


def test_migration_is_planned_verified_and_swapped(spark, tmp_path):
    from corpusloom.operators import migration

    chunk = "document_id string, pos int, chunk_id string, text string, has_image boolean"
    stored = spark.createDataFrame([("a", 0, "a::0", "x", None), ("a", 1, "a::1", "y", None), ("b", 0, "b::0", "z", None)], chunk)
    fresh = spark.createDataFrame([("a", 0, "a::0", "x", True), ("a", 1, "a::1", "y", False), ("b", 0, "b::0", "other", True)], chunk)
    vectors = spark.createDataFrame([(i, "t", [1.0], {"lang": "fr"}) for i in ("a::0", "a::1", "b::0")], "chunk_id string, document string, embedding array<double>, metadata map<string,string>")
    target = f"{tmp_path}/vectors"
    vectors.write.parquet(target)
    old = spark.read.parquet(target)
    same = lambda df: df.select(F.lit(1).alias("qid"), "chunk_id").groupBy("qid").agg(F.array_join(F.sort_array(F.collect_list("chunk_id")), ",").alias("ids"))
    plan = migration.migrate(old, stored, fresh, ["has_image"], target, same)
    assert {r.chunk_id: r.wanted["has_image"] for r in plan.collect()} == {"a::0": "true", "a::1": "false"}
    assert spark.read.parquet(target).filter("map_contains_key(metadata, 'has_image')").count() == 0
    with pytest.raises(sinks.VerificationError, match="results"):
        migration.migrate(old, stored, fresh, ["has_image"], target, lambda df: df.select(F.lit(1).alias("qid"), F.size("metadata").cast("string").alias("ids")).distinct().limit(1) if "wanted" in df.columns else df.groupBy().agg(F.lit(1).alias("qid"), F.max(F.size("metadata")).cast("string").alias("ids")).select("qid", "ids"), apply=True)
    migration.migrate(old, stored, fresh, ["has_image"], target, same, apply=True)
    spark.catalog.refreshByPath(target)
    got = {r.chunk_id: r.metadata for r in spark.read.parquet(target).collect()}
    assert got == {"a::0": {"lang": "fr", "has_image": "true"}, "a::1": {"lang": "fr", "has_image": "false"}, "b::0": {"lang": "fr"}}
    wrong = spark.createDataFrame([("a::0", {"has_image": "false"})], "chunk_id string, wanted map<string,string>")
    assert [tuple(r) for r in catalog.snapshot_diff(vectors, spark.read.parquet(target), ["has_image"], expected=wrong).collect()] == [("a::0", "expected:has_image")]


def test_repeated_rows_multiply_nothing(spark):
    files = spark.createDataFrame([("f", "d1"), ("g", "d2")], "name string, document_id string")
    twice = spark.createDataFrame([("d1",), ("d1",)], "document_id string")
    assert sorted((r.name, r.state) for r in catalog.index_status(files, twice).collect()) == [("f", "indexed"), ("g", "not_indexed")]
    assert catalog.index_status_versioned(files, twice).count() == 2


def test_documents_that_hold_both_files(spark):
    files = spark.createDataFrame([(p,) for p in ("x/a/pivot.md", "x/a/chunks.json", "x/b/pivot.md", "x/b/other.md", "x/c/chunks.json")], "path string")
    assert [r.document_id for r in corpus.documents_with(files, "pivot.md", "chunks.json").collect()] == ["a"]
    assert sorted(r.document_id for r in corpus.documents_with(files, "pivot.md").collect()) == ["a", "b"]


def test_structural_sections_and_blank_blocks_make_no_chunk(spark):
    rows = [("d", 0, "heading", "# T", ["Sommaire"]), ("d", 1, "prose", "a list", ["Sommaire"]), ("d", 2, "prose", "text", ["Part"]), ("d", 3, "prose", " \n ", ["Part"])]
    blocks = spark.createDataFrame(rows, "document_id string, block_index int, kind string, text string, heading_trail array<string>")
    assert [r.block_index for r in chunking.content_blocks(chunking.without_structural(blocks)).collect()] == [2]


def test_article_code_comes_from_its_sources(spark):
    from corpusloom.operators import content

    articles = spark.createDataFrame([("a", "Text.\n```py\nx = 1\n```\n```\ny\n```")], "article string, text string")
    sources = spark.createDataFrame([("a", "S1", "```\nx = 1\n```"), ("b", "S1", "```\ny\n```")], "article string, source string, text string")
    assert [tuple(r) for r in content.citation_check(articles, sources).collect()] == [("a", "code", "y\n")]


def test_long_pages_split_into_blocks(spark):
    """Against a plain reading, line by line; prose of any length is one block."""
    page = "# T\n\n" + "word " * 60_000 + "\nnext line\n\n```\nx\n\n# y\n```\n\nend"
    got = chunking.split_blocks(spark.createDataFrame([("d", page)], "document_id string, pivot_md string")).orderBy("block_index").collect()
    want, held, fence = [], [], False
    for line in [*page.split("\n"), ""]:
        mark = line.startswith("```")
        if not fence and (not line.strip() or mark or line.startswith("# ")) and held:
            want.append("\n".join(held).strip())
            held = []
        if line.strip() or fence:
            held.append(line)
        if not fence and line.startswith("# ") or mark and fence:
            want.append("\n".join(held).strip())
            held = []
        fence ^= mark
    assert [r.text for r in got] == want and [r.kind for r in got] == ["heading", "prose", "code", "prose"]


def test_greedy_chunks_equal_a_plain_fold(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for doc, size in enumerate([1, 2, 7, 60, 400]):
        chunk = used = 0
        for i, n in enumerate(rng.choice([0, 1, 3, 9, 10, 11, 25], size)):
            if used > 0 and used + n > 10:
                chunk, used = chunk + 1, 0
            used += int(n)
            rows.append((doc, i, int(n)))
            want[doc, i] = chunk
    blocks = spark.createDataFrame(rows, "doc_id long, block_index int, n_tokens int").repartition(3)
    got = {(r.doc_id, r.block_index): r.chunk_index for r in chunking.greedy_chunks(blocks, 10).collect()}
    assert got == want
    assert chunking.greedy_chunks(blocks.filter("false")).count() == 0


def test_greedy_chunks_unknown_length(spark):
    blocks = spark.createDataFrame([(1, 0, None), (1, 1, 9), (1, 2, None), (1, 3, 2)], "doc_id long, block_index int, n_tokens int")
    assert [r.chunk_index for r in chunking.greedy_chunks(blocks, 10).orderBy("block_index").collect()] == [0, 0, 0, 1]


def test_stated_sets_go_in_blocks(spark):
    stated = spark.range(100).withColumnRenamed("id", "qid")
    parts = in_blocks(stated, "qid", 10)
    assert len(parts) == 20
    assert sorted(r.qid for p in parts for r in p.collect()) == list(range(100))
    assert len(in_blocks(stated, "qid", 100)) == len(in_blocks(stated.filter("false"), "qid", 100)) == 1


def test_model_limits_name_their_source(spark):
    models = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, max_tokens int")
    configs = spark.createDataFrame([("a", '{"max_seq_length": 9}'), ("b", "{}")], "name string, config string")
    assert sorted(tuple(r) for r in chunking.model_limits(models, configs).collect()) == [("a", 9, "config"), ("b", 2, "no_key"), ("c", 3, "no_config")]
