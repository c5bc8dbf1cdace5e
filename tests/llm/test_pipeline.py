"""Every stage of the pipeline against brute force on what its predecessor kept."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

from .test_operators import shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(10**6, None, "en", "s", 0), (10**6 + 1, " 12 !? ", "en", "s", 7), (10**6 + 2, "", None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(1))
    out = [docs.collect()]
    for name, stage in cp.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def test_later_stages_let_heaps_shrink_first(spark, monkeypatch):
    class Asked(Exception):
        pass

    def ask(session):
        raise Asked

    monkeypatch.setattr(cp, "shrink", ask)
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[1:]:
        with pytest.raises(Asked):
            stage(spark, docs, "")


def test_columns(stages):
    for rows in stages[1:-1]:
        assert rows[0].__fields__ == COLUMNS


def test_language_keeps_clean_documents(stages):
    before, after = stages[0], stages[1]
    want = sorted(r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or ""))
    assert sorted(r.doc_id for r in after) == want


def test_language_keeps_text_mixed_of_many_languages(spark):
    rng = random.Random(14)
    pools = [[a + b + c for a in "".join(ab) for b in "aeiou" for c in ("", "n", "r")] for ab in ("bc", "df", "gh", "jk", "lm", "pq")]

    def prose(pool, n):
        return " ".join("".join(rng.sample(pool, 3)) for _ in range(n))

    rows = [(10 * k + j, prose(pool, 40), f"l{k}", "s", 0) for k, pool in enumerate(pools) for j in range(10)]
    rows += [(1000 + j, " ".join(prose(pool, 12) for pool in pools), None, "s", 0) for j in range(4)]
    docs = spark.createDataFrame([*rows, (2000, "12 !?", "l0", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in cp.language_id(spark, docs, "").collect()) == sorted(r[0] for r in rows)


def test_null_and_shared_ids(spark):
    """Every row is judged by itself: dropping one takes no other of its id, and null ids are no refuge."""
    rng = random.Random(15)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(900)}" for _ in range(100)) for _ in range(5))

    def run(stage, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        out = stage(spark, docs, "").collect()
        assert not out or out[0].__fields__ == COLUMNS
        return sorted(((r.doc_id, r.text) for r in out), key=str)

    def want(*rows):
        return sorted(rows, key=str)

    assert run(cp.language_id, [(1, a), (7, b), (7, None), (None, c), (None, "12"), (None, None)]) == want((1, a), (7, b), (None, c))
    spaced = b.replace(" ", "  ")
    assert run(cp.exact_copies, [(3, a), (7, a), (7, b), (7, spaced), (7, spaced), (None, a), (None, c), (None, c), (None, d)]) == want((3, a), (7, spaced), (None, c), (None, d))
    near_a, near_c = a + " more", c + " more"
    got = run(cp.near_copies, [(3, a), (7, near_a), (7, b), (-2, e), (None, near_a), (None, c), (None, near_c), (None, d)])
    assert got in (want((3, a), (7, b), (-2, e), (None, x), (None, d)) for x in (c, near_c))


def test_exact(stages):
    groups = {}
    for r in stages[1]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), []).append(r)
    want = sorted(min(g, key=lambda r: (-len(r.text), r.doc_id)).doc_id for g in groups.values())
    assert sorted(r.doc_id for r in stages[2]) == want


def test_near(stages):
    sets = {r.doc_id: shingles(r.text, 5) for r in stages[2]}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert sorted(r.doc_id for r in stages[3]) == sorted(i for i in sets if label[i] == i)


def test_passages(stages):
    seen, want = set(), {}
    for r in sorted(stages[3], key=lambda r: r.doc_id):
        raw = r.text.encode()
        gone = bytearray(len(raw))
        windows = [raw[s : s + 50] for s in range(len(raw) - 49)]
        for s, w in enumerate(windows):
            if w in seen:
                gone[s : s + 50] = b"\1" * 50
        seen.update(windows)
        at, kept = 0, []
        for c in r.text:
            n = len(c.encode())
            if not any(gone[at : at + n]):
                kept.append(c)
            at += n
        want[r.doc_id] = ("".join(kept), r.lang, r.source, len(kept))
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in stages[4]} == want


def test_packing(stages):
    pieces, sequences = {}, {}
    for r in stages[5]:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == {r.doc_id for r in stages[4]}
    for rows in pieces.values():
        assert [r[0] for r in sorted(rows)] == list(range(len(rows)))
    total = 0
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert len(sequences) <= -(-total // 2048) + 1


def test_odd_tables(spark):
    """Empty tables, extra columns whose names clash with inner ones, a very long text, ties and repeats."""
    rng = random.Random(18)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, uid long, row_id long, kept boolean, sha string, bands string, key string"
    rows = [(1, long, "en", "s", 0), (2, long, "en", "s", 0), (3, "one", "en", "s", 0), (3, "one", "en", "s", 0), (4, None, None, None, None), (5, "", "en", None, 0)]
    docs = spark.createDataFrame([(*r, 7, 7, 7, True, "x", "y", "z") for r in rows], schema)
    for name, stage in cp.STAGES:
        none = stage(spark, docs.limit(0), "").collect()
        assert none == [], name
        docs = stage(spark, docs, "")
        if name != cp.STAGES[-1][0]:
            assert docs.columns == COLUMNS
            docs = docs.select("*", *(F.lit(7).alias(c) for c in ("id", "uid", "row_id", "kept", "sha", "bands", "key"))).persist()
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == {1, 3}
    assert len([r for r in pieces if r.doc_id == 3]) == 1 and len([r for r in pieces if r.doc_id == 1]) > 29


def test_order_of_stages():
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "minhash_dedup", "suffix_dedup", "best_fit_packing"]
