"""Each operator against brute force on a small, awkward table; and what it does with odd rows."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann_search, byte_bpe, chat_format, components, exact_dedup, language_crf, license_scan, license_texts, minhash_dedup, packing, pieces, suffix_dedup, suffix_order, textnum, token_counts

SCHEMA = "doc_id long, text string, lang string, id long, uid long, n long, key string, v string"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}{'x' * rng.randrange(4)}" for _ in range(n))


def make_texts():
    rng = random.Random(5)
    base = words(rng, 120)
    parts = base.split(" ")
    near = " ".join("changed" if i == 60 else w for i, w in enumerate(parts))
    long = words(rng, 6000)
    passage = words(rng, 60)
    texts = {
        1: base, 2: near, 3: base, 4: base.replace(" ", "\n "), 5: None, 6: "", 7: " \t\n", 8: "one", 9: "one", 10: long,
        11: words(rng, 40) + " " + passage + " " + words(rng, 40), 12: passage + " " + words(rng, 10), 13: words(rng, 30) + passage[7:],
        14: "ab" * 300, 15: "ab" * 40, 16: "é中🙂 don't 'll  x y", 17: "<|endoftext|> 123 4567 !!'s", 18: "z" * 700,
    }
    return list(texts.items())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i, i, 1, "k", "v") for i, t in make_texts()]
    return spark.createDataFrame([*rows, rows[0], (None, "nobody's text here", None, 0, 0, 0, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


TEXTS = dict(make_texts())


def shingles(text, n=2):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, empty, width):
    rows = minhash_dedup.near_duplicates(docs, minhash_dedup.NearDup(words=width)).collect()
    got = {r.doc_id: r for r in rows}
    sets = {i: shingles(t, width) for i, t in TEXTS.items()}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] > label[b]:
                    label[a], changed = label[b], True
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), label[i], label[i] == i), i
    assert got[None].component_id is None and got[None].kept
    assert len(rows) == docs.count()
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_near_duplicate_chain_is_one_component(spark):
    """Neighbours in the chain link, its ends don't; buckets are compared in tiles."""
    rng = random.Random(9)
    w = words(rng, 100, 10**6).split(" ")
    rows = []
    for i in range(30):
        rows.append((i, " ".join(w)))
        w[(i * 3) % 100] = f"new{i}"
        w[(i * 3 + 1) % 100] = f"newer{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_duplicates(df, minhash_dedup.NearDup(words=2, small=2, tile=4)).collect()
    assert {r.component_id for r in got} == {0}


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(0)
    p = minhash_dedup.NearDup(bands=128, rows=5)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    b = np.concatenate([a[:720], rng.integers(0, 2**63, 180).astype(np.uint64)])
    s = minhash_dedup.signatures(np.concatenate([a, b]), np.array([900, 900]), p)
    assert abs((s[0] == s[1]).mean() - 720 / 1080) < 0.07


def test_near_duplicates_make_few_shuffles(spark):
    """The driver holds the plan of every shuffle and its tasks' figures: these rows made 79 before, and make 66."""
    words = [f"w{i}" for i in range(60)]
    df = spark.createDataFrame([(i, " ".join(words[i : i + 40])) for i in range(12)], "doc_id long, text string")
    context, key = spark.sparkContext._jsc.sc(), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        before = context.newShuffleId()
        got = minhash_dedup.near_duplicates(df, minhash_dedup.NearDup(words=2, small=2, tile=4)).collect()
        assert context.newShuffleId() - before <= 70
    finally:
        spark.conf.unset(key)
    assert {r.component_id for r in got} == {0}


def test_shrink_collects_where_tasks_run(spark):
    from corpusloom.llm import common

    def collections():
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans)

    before = collections()
    common.shrink(spark)
    assert collections() > before


def test_components_settle_on_chains(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (5, 5)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == got[100] == 100


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    got = {r.doc_id: r for r in rows}
    normal = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in TEXTS.items()}
    for i, n in normal.items():
        group = [j for j in normal if normal[j] == n]
        keep = min(group, key=lambda j: (-len(TEXTS[j] or ""), j))
        size = len(group) + (1 in group)  # row 1 is there twice
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, size, keep == i, hashlib.sha256(n.encode()).hexdigest()), i
    assert len(rows) == len(TEXTS) + 1 and got[None].kept
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_tells_colliding_texts_apart(spark):
    """With a key of one digit most groups collide; the texts decide."""
    texts = [f"text {k % 40}{' ' * (k % 3)}" for k in range(130)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), key_digits=1).collect()
    assert len(got) == len(texts)
    for r in got:
        group = [j for j, t in enumerate(texts) if t.replace(" ", "") == texts[r.doc_id].replace(" ", "")]
        assert (r.group_size, r.keep_id) == (len(group), min(group, key=lambda j: (-len(texts[j]), j)))


@pytest.mark.parametrize("depth", [None, 50])
def test_suffix_order(depth):
    rng = np.random.default_rng(1)
    for k in range(25):
        text = rng.integers(1, 2 + k % 3, int(rng.integers(1, 500))).astype(np.uint8)
        if k % 3 == 0:
            text = np.tile(text[: max(1, len(text) // 6)], 6)
        raw = text.tobytes()
        got = suffix_order.suffix_order(text, np.arange(len(text)), depth, bucket=64).tolist()
        if depth is None:
            assert got == sorted(range(len(raw)), key=lambda i: raw[i:])
        else:
            heads = [raw[i : i + 8] for i in got]
            assert heads == sorted(heads)


def cut(texts):
    """Brute force: (bytes, removed, runs, kept) of every text by ascending id."""
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        windows = [raw[s : s + 50] for s in range(len(raw) - 49)]
        gone = [False] * len(raw)
        for s, w in enumerate(windows):
            if w in seen:
                gone[s : s + 50] = [True] * 50
        seen |= set(windows)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("crowd", [4096, 2])
def test_remove_repeats(docs, empty, crowd):
    rows = suffix_dedup.remove_repeats(docs, suffix_dedup.Repeats(crowd=crowd), carry=("lang",)).collect()
    want = cut(TEXTS)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert {i: v for i, v in got.items() if i is not None} == want
    assert got[None][1] == 0 and len(rows) == len(TEXTS) + 1
    assert {r.lang for r in rows if r.doc_id is not None} == {"en"}
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_repeats_after_an_empty_text(spark):
    """An empty row straight before a text takes nothing from the text's first window."""
    rng = random.Random(12)
    passage = words(rng, 30)[:50]
    texts = {1: words(rng, 20) + passage + words(rng, 20), 2: "", 3: passage, 4: None, 5: passage + words(rng, 20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == cut(texts)
    assert got[3][1] == 50 and got[5][1] >= 50


def test_anchor_runs_of_rows_after_empty_ones():
    p = suffix_dedup.Repeats()
    part = np.random.default_rng(3).integers(97, 123, 120).astype(np.uint8)
    for edges in ([0, 50, 50, 100, 100, 100, 120], [0, 0, 60, 60, 120, 120]):
        _, row, s0, s1, _ = suffix_dedup.anchor_runs(part, np.array(edges), p)
        got = sorted((r, s) for r, a, b in zip(row.tolist(), s0.tolist(), s1.tolist(), strict=True) for s in range(a, b + 1))
        assert got == [(r, s) for r, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) for s in range(a, b - 49)]


def test_whole_characters_go(spark):
    tail = "é" * 30
    df = spark.createDataFrame([(1, "a" + tail), (2, "b" + tail + "c")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(df, whole_chars=True).collect()} == {1: "a" + tail, 2: "bc"}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t in TEXTS.items():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want = sorted((k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048)) for part in [ids[at : at + 2048]])
        times = 2 if i == 1 else 1
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want * times), i
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_packing_query_gives_added_tokens_their_ids(spark, tmp_path):
    """The registered query's ids are the library's at its default setting."""
    from tokenizers import Tokenizer

    from corpusloom.llm.queries import op4_packing

    tok = Tokenizer.from_file(WORD_BPE)
    texts = [
        "a <|endoftext|> b", "A<|ENDOFTEXT|>b", "<|endoftext|>", "<|startoftext|><|endoftext|>é", "e<|endoftext|>\u0301x", "don<|endoftext|>'t", "<<|endoftext|>>",
        "  <|endoftext|>  ", "<|endoftext|", "", None, "plain", "word <|startoftext|> " * 1500, "É中🙂<|endoftext|>É",
    ]
    rows = [*enumerate(texts), *((100 + i, t) for i, t in TEXTS.items())]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in op4_packing(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        assert sorted(got[i]) == [(k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 2048))], t


def test_genetic_packing_saves_bins():
    rng = np.random.default_rng(2)
    sizes = rng.integers(300, 1000, 900)
    people = packing.settle(sizes, 2048, rng, 3)
    best = packing.evolve(sizes, [p.copy() for p in people], 2048, rng, 30)[0]
    assert packing.loads(sizes, best).max() <= 2048
    assert packing.fitness(sizes, best, 2048) >= max(packing.fitness(sizes, p, 2048) for p in people)


def test_byte_bpe(docs, empty):
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.bpe_round_trip(docs, RANKS, with_ids=True).collect()}
    for i, t in TEXTS.items():
        ids = enc.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids), i
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.bpe_round_trip(empty, RANKS).count() == 0


def thue_morse(n):
    """A word whose complement collides with it under any polynomial hash modulo 2**64, from 1,024 letters on."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


COMPLEMENTS = [x for n in (1024, 2048, 4096) for x in (thue_morse(n), thue_morse(n).translate(str.maketrans("ab", "ba")))]


def tiktoken_encoding():
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_recursive_merges_equal_the_library(monkeypatch):
    """Short and long pieces, whole queries and queries that stop and go on, splits and none."""
    enc, bpe, rng = tiktoken_encoding(), byte_bpe.ByteBPE(RANKS), random.Random(4)
    samples = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 60))).encode() for _ in range(300)]
    samples += [x.encode() for x in ("z" * 900, "ab" * 400, "zzz" * 101, "lalaland" * 60, "etaoin" * 77, "汉字文本" * 90)]
    raw = np.frombuffer(b"".join(samples), np.uint8)
    size = np.array([len(s) for s in samples])
    want = [enc.encode_single_token(s) if s in enc._mergeable_ranks else enc._encode_bytes(s) for s in samples]
    want = [[w] if isinstance(w, int) else w for w in want]
    for rows, long in ((2_000_000, 256), (5_000, 256), (50_000, 1)):
        monkeypatch.setattr(byte_bpe, "ROWS", rows)
        monkeypatch.setattr(byte_bpe, "LONG", long)
        ids, n = bpe.encode(raw, np.cumsum(size) - size, np.cumsum(size))
        edge = np.concatenate([[0], np.cumsum(n)])
        assert [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:], strict=True)] == want


@pytest.mark.parametrize("text", ["，".join("".join(chr(0x4E00 + (i * j) % 3001) for j in range(5, 40)) for i in range(400)), " ".join("".join(random.Random(i).choices("etaoinshrdlu", k=400)) for i in range(60)), "".join(random.Random(1).choices("etaoinshrdlu", k=20_000)), " ".join(COMPLEMENTS)], ids=["chinese", "words of 400", "one word", "complements"])
def test_byte_bpe_of_long_words(text):
    (ids, n), (raw, size) = byte_bpe.encode_decode([text, text[: len(text) // 2]], RANKS)
    want = [tiktoken_encoding().encode_ordinary(x) for x in (text, text[: len(text) // 2])]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == want[0] + want[1]
    assert raw.tobytes().decode() == text + text[: len(text) // 2]


def test_words_of_one_hash_stay_apart(spark, monkeypatch):
    """With hashes of two bits everything collides; ids, counts and words are right all the same."""
    from tokenizers import Tokenizer

    real = textnum.span_hashes
    monkeypatch.setattr(textnum, "span_hashes", lambda *a: real(*a) & np.uint64(3))
    for cache in (byte_bpe.byte_bpe, pieces.pair_merges):
        cache.cache_clear()
    packing._cache.clear()
    texts = [words(random.Random(k), 60) for k in range(6)]
    (ids, _), (raw, _) = byte_bpe.encode_decode(texts[:3], RANKS)
    (more, _), _ = byte_bpe.encode_decode(texts[3:], RANKS)
    assert ids.tolist() + more.tolist() == [i for t in texts for i in tiktoken_encoding().encode_ordinary(t)]
    assert raw.tobytes().decode() == "".join(texts[:3])
    got, _ = packing.text_ids(texts, pieces.pair_merges(WORD_BPE), pieces.IdCache(), True)
    assert got.tolist() == [i for t in texts for i in [*Tokenizer.from_file(WORD_BPE).encode(t, add_special_tokens=False).ids, 0]]
    byte_bpe.byte_bpe.cache_clear()


def test_complements_have_sets_of_their_own():
    raw, offsets = textnum.utf8(pa.array(COMPLEMENTS))
    values, _, counts = minhash_dedup.shingle_sets(raw, offsets, 2)
    assert counts.tolist() == [1] * len(COMPLEMENTS) and len(set(values.tolist())) == len(COMPLEMENTS)


def test_token_counts(docs, empty):
    vocabulary = [b" the", b" th", b"the", b"abcd", b"bcde", b"ab", b"cd", b" w1", b"xx", b"x", b" z", b"zzzz"]
    machine = token_counts.LongestMatch(vocabulary)
    tokens = set(vocabulary) | {bytes([b]) for b in range(256)}

    def greedy(word):
        s, n = b" " + word, 0
        while s:
            k = max(k for k in range(1, len(s) + 1) if s[:k] in tokens)
            s, n = s[k:], n + 1
        return n

    rng = random.Random(8)
    samples = [bytes(rng.choice(b"abcdethxz w1") for _ in range(rng.randrange(1, 30))).replace(b" ", b"a") for _ in range(400)]
    raw = np.frombuffer(b"".join(samples), np.uint8)
    ends = np.cumsum([len(s) for s in samples])
    assert machine.counts(raw, ends - [len(s) for s in samples], ends).tolist() == [greedy(s) for s in samples]
    got = {r.doc_id: r for r in token_counts.token_counts(docs, RANKS).collect()}
    # Whole documents under the real vocabulary.
    tokens = set(tiktoken_encoding()._mergeable_ranks) | {bytes([b]) for b in range(256)}
    longest = max(map(len, tokens))

    def whole(word):
        s, n = b" " + word, 0
        while s:
            k = max(k for k in range(1, min(len(s), longest) + 1) if s[:k] in tokens)
            s, n = s[k:], n + 1
        return n

    for i, t in [*TEXTS.items(), (None, "nobody's text here")]:
        found = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        assert (got[i].n_words, got[i].n_tokens) == (len(found), sum(map(whole, found))), i
    assert token_counts.token_counts(empty, RANKS).count() == 0


def test_license_scan(spark, docs, empty):
    british = license_texts.MIT.replace("sublicense", "sub-licence").upper()
    rows = [(1, "The MIT Licence (MIT)\n\nCopyright (c) 2020 Someone\n\n" + british), (2, license_texts.BSD_3.replace(".", " ;")), (3, license_texts.MIT + " And more."), (4, None), (5, "Licensed under CC BY-NC 4.0."), (6, license_texts.ISC.replace("\n", " "))]
    got = {r.doc_id: r.license_id for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "BSD-3-Clause", 3: None, 4: None, 5: "CC-BY-NC-4.0", 6: "ISC"}
    assert {r.license_id for r in license_scan.license_scan(docs).collect()} == {None}
    assert license_scan.license_scan(empty).count() == 0
    one = spark.createDataFrame(rows[4:5] * 2, "doc_id long, text string")
    assert [r.license_id for r in license_scan.license_scan(one, []).collect()] == [None, None]
    own = license_scan.digest("Licensed under CC BY-NC 4.0.")
    assert [r.license_id for r in license_scan.license_scan(one, [(own, "old"), (own, "new")]).collect()] == ["new", "new"]


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="needs Debian's licence texts")
def test_long_licenses(spark):
    """Whole texts as distributed, and with other case, line breaks, punctuation and copyright lines."""
    want = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0"}
    texts = {f: open(f"/usr/share/common-licenses/{f}", encoding="utf-8").read() for f in want}
    rows = [(f, t) for f, t in texts.items()] + [(f, "Copyright (c) 2024 A. Person\n\n" + t.upper().replace(",", " -")) for f, t in texts.items()]
    rows += [("none", t[: len(t) // 2]) for t in texts.values()]
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and all(r.license_id == want.get(r.doc_id) for r in got)


def test_chat_parts(spark):
    rows = [
        (1, 1, "assistant", [("text", "a < b \\ <|im_end|>", None, None)]),
        (1, 0, "us\ner<n", [("text", "see <", None, None), ("text", "|im_start|>", None, None), ("image", None, "i.png", 57), ("audio", None, "a.wav", None)]),
        (2, None, None, None), (None, 0, "assistant", [("odd", "x", "ref", 1)]),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,size:bigint>>").withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat_format.parse_chats(chat_format.format_chats(df.unionByName(df.filter("conv_id = 2")))).collect()}
    one = got[1]
    assert [(p.role, p.text) for p in one.parsed] == [("us\ner<n", "see <|im_start|><|image|><|audio|>"), ("assistant", "a < b \\ <|im_end|>")]
    assert [(a.slot, a.kind, a.ref, a.tokens) for a in one.attachments] == [(0, "image", "i.png", 27), (1, "audio", "a.wav", 1)]
    assert one.expanded_tokens == 28 and one.formatted.count("<|im_end|>") == 2
    (span,) = one.loss_spans
    assert one.formatted[span.start : span.end] == "a <\\ b \\\\ <\\|im_end|>"
    assert got[2].n_turns == 2 and [(p.role, p.text) for p in got[2].parsed] == [("", "")] * 2
    assert got[None].parsed[0].text == "x"
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_language_crf(spark, docs, empty):
    rng = random.Random(6)
    pools = {"aa": ["kala", "kuma", "tila", "mira", "sola"], "bb": ["brek", "grunt", "strom", "plick", "drun"]}
    rows = [(i, " ".join("".join(rng.sample(pools[g], 2)) for _ in range(40)), g) for i in range(40) for g in [("aa", "bb")[i % 2]]]
    model = language_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = " ".join(["kalamira tilasola"] * 6 + ["brekgrunt strom plickdrun"] * 6)
    tests = [(1, "Kalakuma miratila"), (2, "plickbrek drungrunt"), (3, None), (4, "12 !? "), (5, mixed), (6, "kala " * 30_000)]
    got = {r.doc_id: r for r in language_crf.identify(spark.createDataFrame(tests, "doc_id long, text string"), model, with_words=True).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 6)] == ["aa", "bb", "und", "und", "aa"]
    assert [r.lang for r in got[5].words] == ["aa", "bb"] and got[5].words[0].last == 11
    assert got[3].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert language_crf.identify(empty, model).count() == 0
    nothing = language_crf.train(empty)
    assert {r.lang_pred for r in language_crf.identify(docs, nothing).collect()} == {"und"}


def test_language_sample_is_bounded_rows(spark, monkeypatch):
    """Rows count, not ids, and so do bytes; texts are whole."""
    seen = []
    monkeypatch.setattr(language_crf.LanguageCRF, "fit", lambda self, texts, langs: seen.append(list(zip(langs, texts, strict=True))) or self)
    rows = [(7, f"kala {i}", "aa") for i in range(10_000)] + [(i, f"brek {i}", "bb") for i in range(3000)] + [(i, "x" * 1000, "cc") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = language_crf.CRFParams(sample_bytes=5000)
    assert language_crf.train(df, p).labels == language_crf.train(df.repartition(7), p).labels == ["aa", "bb", "cc"]
    assert seen[0] == seen[1]
    n = {g: sum(x == g for x, _ in seen[0]) for g in ("aa", "bb", "cc")}
    assert n == {"aa": 150, "bb": 150, "cc": 5} and {t for g, t in seen[0] if g == "cc"} == {"x" * 1000}


def test_language_crf_learns_every_language(spark):
    rng = random.Random(16)
    pools = {f"l{k:02}": ["".join(rng.choice("bcdfghjklmnpqrstvwz") + rng.choice("aeiou") for _ in range(2)) for _ in range(5)] for k in range(70)}

    def prose(g):
        return " ".join("".join(rng.sample(pools[g], 2)) for _ in range(30))

    rows = [(100 * j + k, prose(g), g) for k, g in enumerate(pools) for j in range(3 if k < 64 else 2)]
    model = language_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(k, prose(g)) for k, g in enumerate(pools)]
    got = {r.doc_id: r.lang_pred for r in language_crf.identify(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert got == dict(enumerate(pools))


def test_chain_posteriors():
    rng = np.random.default_rng(0)
    counts = np.array([1, 70, 0, 33, 5])
    emit, trans = rng.normal(size=(counts.sum(), 3)), rng.normal(size=(3, 3))
    got, at = language_crf.chain_posteriors(emit, trans, counts), 0
    for c in counts[counts > 0]:
        e, a = np.exp(emit[at : at + c]), np.exp(trans)
        f, b = [e[0]], [np.ones(3)]
        for t in range(1, c):
            f.append((f[-1] @ a) * e[t] / e[t].sum())
        for t in range(c - 2, -1, -1):
            b.insert(0, a @ (e[t + 1] * b[0]) / e[t + 1].sum())
        p = np.array(f) * np.array(b)
        assert np.allclose(got[at : at + c], p / p.sum(axis=1, keepdims=True))
        at += c


def test_ann_search(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    x[1000:2000] = x[0]  # a third of all rows are one vector
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0] * 3), (None, [1.0] * 16), (5080, [None] + [1.0] * 15)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    got = {}
    for r in ann_search.search(df, "id % 20 = 0").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, hit, total = np.arange(3000), 0, 0
    assert set(got) == set(range(0, 3000, 20))
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort([ids, -score])[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(score[f[1]] - f[2]) < 1e-9 for f in found)
        hit += len(set(want.tolist()) & {f[1] for f in found})
        total += 20
    assert hit / total >= 0.9
    few = ann_search.search(df.filter("vec_id < 4"), "id % 20 = 0").collect()
    assert len(few) == 3
    assert ann_search.search(df.limit(0), "id % 20 = 0").count() == 0
