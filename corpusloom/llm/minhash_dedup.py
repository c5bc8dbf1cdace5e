"""Near-duplicate documents by circulant MinHash, banding, and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnum as tn
from .common import checkpoint, modest_batches, small_side
from .components import connected_components

U64 = np.uint64
#: Rows taken at once.
ROWS = 4096


@dataclass(frozen=True)
class NearDup:
    """``words`` in a shingle; documents link at ``100 * |A & B| >= percent * |A | B|``.

    ``bands`` of ``rows`` signature coordinates: at 80 percent, 32 bands of 5 miss a link with a
    probability of 3e-6. ``universe`` is the length of the two permutations, a power of two. Buckets of
    more than ``small`` members are compared in tiles of about ``tile`` by ``tile``.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    universe: int = 1 << 20
    small: int = 24
    tile: int = 128
    seed: int = 20


@lru_cache(2)
def permutations(p: NearDup) -> tuple[np.ndarray, np.ndarray]:
    """sigma, and the windows of pi: window i holds pi at i, i + 1, ..., once around the circle."""
    rng = np.random.default_rng(p.seed)
    sigma = rng.permutation(p.universe).astype(np.uint32)
    pi = rng.permutation(p.universe).astype(np.uint32)
    k = p.bands * p.rows
    return sigma, np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: k - 1]]), k)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end; a second, independent hash of each; and
    how many each row has."""
    starts, ends, n_words = tn.words(raw, offsets)
    edge = np.concatenate([[0], np.cumsum(n_words)])
    n_full = np.maximum(n_words - width + 1, 0)
    first = np.ones(len(starts), bool)  # a full shingle starts at each word with width - 1 more after it in its row
    for k in range(1, width):
        first[edge[1:][n_words >= k] - k] = False
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    first[edge[short]] = True  # a shorter sequence is one shingle
    n_shingles = n_full.copy()
    n_shingles[short] = 1
    first = np.flatnonzero(first)
    size = np.repeat(np.minimum(n_words, width), n_shingles)
    value, second = (_chained(tn.word_hashes(raw, starts, ends, lane), first, size) for lane in (0, 1))
    to = np.concatenate([[0], np.cumsum(n_shingles)])
    order = np.empty(len(value), np.int64)
    for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True):
        order[a:b] = np.argsort(value[a:b])
        order[a:b] += a
    value, second = value[order], second[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[to[:-1][n_shingles > 0]] = True
    counts = np.diff(np.concatenate([[0], np.cumsum(new)])[to])
    return value[new], second[new], counts


def _chained(h: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of so many words from each place on."""
    v = tn.mix(h[at] ^ size.astype(U64)) if len(at) else np.empty(0, U64)
    with np.errstate(over="ignore"):
        for k in range(1, int(size.max(initial=0))):
            more = slice(None) if (size > k).all() else size > k
            v[more] = tn.mix(v[more] * U64(0x9FB21C651E98DF25) + h[at[more] + k])
    return v


def signatures(values: np.ndarray, counts: np.ndarray, p: NearDup) -> np.ndarray:
    """Coordinate k of a set is the least pi(sigma(x) + k mod universe) over its members x."""
    sigma, windows = permutations(p)
    out = np.full((len(counts), p.bands * p.rows), p.universe, np.uint32)
    at = sigma[(values >> U64(17)) & U64(p.universe - 1)]
    edge = np.concatenate([[0], np.cumsum(counts)])
    for d, (lo, hi) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
        for a in range(lo, hi, 2048):
            np.minimum(out[d], windows[at[a : min(hi, a + 2048)]].min(axis=0), out=out[d])
    return out


def band_keys(signature: np.ndarray, p: NearDup) -> np.ndarray:
    parts = signature.reshape(len(signature), p.bands, p.rows).astype(U64)
    key = np.broadcast_to(np.arange(1, p.bands + 1, dtype=U64), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(p.rows):
            key = tn.mix(key * U64(0x9FB21C651E98DF25) + parts[:, :, k])
    return key.view(np.int64)


def _digests(values: np.ndarray, seconds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as sums of two independent scrambles of its members."""
    edge = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for each in (tn.mix(values), tn.mix(seconds)):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(each, dtype=U64)])
        out.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return out[0], out[1]


def _ranged(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, offsets = tn.utf8(column)
    for first, last in tn.row_ranges(offsets, 2 << 20):
        for lo in range(first, last, ROWS):
            hi = min(last, lo + ROWS)
            yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    edge = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(flat, kind))


def sketches(docs: DataFrame, p: NearDup, id_col: str, text_col: str) -> DataFrame:
    """``id, n, h1, h2, bands``: set size, set digest and band keys (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in _ranged(batch.column(1)):
                values, seconds, counts = shingle_sets(raw, offsets, p.words)
                h1, h2 = _digests(values, seconds, counts)
                keys = band_keys(signatures(values, counts, p), p)[counts > 0]
                bands = _lists(keys.reshape(-1), np.where(counts > 0, p.bands, 0), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)), pa.array(h1), pa.array(h2), bands], names=["id", "n", "h1", "h2", "bands"])
        tn.trim()

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n", "h1", "h2")), T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def full_sets(docs: DataFrame, p: NearDup, id_col: str, text_col: str) -> DataFrame:
    """``id, h1, h2, members``: whole shingle sets as sorted 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in _ranged(batch.column(1)):
                values, seconds, counts = shingle_sets(raw, offsets, p.words)
                h1, h2 = _digests(values, seconds, counts)
                edge = np.concatenate([[0], np.cumsum(counts)])
                sets = [values[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(h1), pa.array(h2), pa.array(sets, pa.binary())], names=["id", "h1", "h2", "members"])
        tn.trim()

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("members", T.BinaryType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add the set sizes ``n_a, n_b`` and ``shared``, the exact size of the intersection, to pairs (a, b)."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("members").alias("a_set"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("members").alias("b_set"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_set", "b_set", "n_a", "n_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), U64) for c in (2, 3))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared[i] = int((y[at] == x).sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (0, 1, 4, 5)), pa.array(shared)], names=["a", "b", "n_a", "n_b", "shared"])

    schema = T.StructType([*(both.schema[c] for c in ("a", "b", "n_a", "n_b")), T.StructField("shared", T.LongType())])
    return both.mapInArrow(run, schema)


def _tiles(members: DataFrame, p: NearDup) -> DataFrame:
    """Links (a, b) that join components, between the ``outside`` rows of large buckets and all their members.

    Members are dealt into chunks by hash; a task sees two chunks of a bucket, and returns links that
    these need, not pairs. A pair is measured only in the first bucket that it shares, and only if its
    sizes and its distances to the centre allow a link.
    """
    parts = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(p.tile)).alias("parts"))
    row = F.struct("rep", "comp", "n", "d", "bands", "members", "outside")
    chunks = checkpoint(members.join(parts, "bucket").groupBy("bucket", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")).agg(F.collect_list(row).alias("y")))
    outside = chunks.select("bucket", F.filter("y", lambda r: r["outside"]).alias("x")).filter(F.size("x") > 0)
    pairs = outside.join(chunks.select("bucket", "y"), "bucket").select("bucket", "x", "y")
    limit = 1 - p.percent / 100 + 1e-9

    def fields(column: pa.Array, i: int) -> tuple:
        own = column[i].values
        sets = [np.frombuffer(v.as_buffer(), U64) for v in own.field("members")]
        bands = own.field("bands").flatten().to_numpy().reshape(len(own), -1)
        return own.field("rep").to_pylist(), own.field("comp").to_pylist(), own.field("n").to_numpy(), own.field("d").to_numpy(zero_copy_only=False), bands, sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for i in range(batch.num_rows):
                bucket = batch.column(0)[i].as_py()
                x_rep, x_comp, x_n, x_d, x_bands, x_sets = fields(batch.column(1), i)
                y_rep, y_comp, y_n, y_d, y_bands, y_sets = fields(batch.column(2), i)
                parent = {c: c for c in [*x_comp, *y_comp]}

                def root(c, parent=parent):
                    while parent[c] != c:
                        parent[c] = c = parent[parent[c]]
                    return c

                for k, own in enumerate(x_sets):
                    band = int(np.argmax(x_bands[k] == bucket))
                    may = 100 * np.minimum(x_n[k], y_n) >= p.percent * np.maximum(x_n[k], y_n)
                    may &= ~(np.abs(y_d - x_d[k]) > limit)  # an unknown distance excludes nothing
                    may &= ~(y_bands[:, :band] == x_bands[k][:band]).any(axis=1)
                    here = root(x_comp[k])
                    some = [j for j in np.flatnonzero(may).tolist() if root(y_comp[j]) != here]
                    if not some:
                        continue
                    flat = np.concatenate([y_sets[j] for j in some])
                    size = y_n[some]
                    hits = np.searchsorted(own, flat)
                    hits[hits == len(own)] = 0
                    shared = np.add.reduceat((own[hits] == flat).astype(np.int64), np.cumsum(size) - size)
                    for j in np.flatnonzero(100 * shared >= p.percent * (x_n[k] + size - shared)).tolist():
                        u, v = root(x_comp[k]), root(y_comp[some[j]])
                        if u != v:
                            parent[max(u, v)] = min(u, v)
                            found.append((x_rep[k], y_rep[some[j]]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], batch.column(1).type.value_type.field("rep").type), pa.array([b for _, b in found], batch.column(1).type.value_type.field("rep").type)], names=["a", "b"])

    kind = members.schema["rep"].dataType
    return pairs.mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def _linked(p: NearDup):
    return F.expr(f"100 * shared >= {p.percent} * (n_a + n_b - shared)")


def _similar_size(p: NearDup, a: str, b: str):
    return F.expr(f"100 * least({a}, {b}) >= {p.percent} * greatest({a}, {b})")


def near_duplicates(docs: DataFrame, params: NearDup | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of near-duplicate documents: ``id_col, n_shingles, component_id, kept``.

    A text's A-Z are lower-cased and its words are the runs of ``[^\\x20\\x09-\\x0D]``; its set holds the
    distinct shingles of ``words`` words, or the one shorter sequence it has. Documents link as
    ``NearDup`` says, on full sets; ``component_id`` is the least id reachable.

    1. One scan makes each document's set digest and circulant MinHash band keys; equal sets (128
       bits) collapse to their least id, so copies cost one narrow row each.
    2. Every band bucket compares its members with its least id only: linear in the bucket. Exact
       intersections of full sets confirm links; connected components join them.
    3. Members of a bucket outside its least id's component are compared with every other member
       that the sizes and the triangle inequality of the Jaccard distance do not exclude, given both
       exact distances to the least id. Buckets of over ``small`` members do this in tiles, which
       return only links that join components. So every pair that shares a bucket is confirmed, excluded by a bound, or
       already in one component.

    Sets are recomputed only for documents in some pair. Hot buckets and hot centres meet joins that
    AQE may split; nothing is grouped in one task.

    Null and empty texts, and those of white space alone, have an empty set, link with nothing and
    are kept. Rows of a null id are returned with a null component and are kept. Repeated rows are
    returned as they come; rows that share an id are one document, so their components merge. Very
    long texts are processed whole. An empty table gives an empty result. Other columns are ignored.
    """
    p = params or NearDup()
    modest_batches(docs)
    sets = checkpoint(sketches(docs, p, id_col, text_col))
    some = sets.filter("n > 0 AND id IS NOT NULL")
    nodes = some.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    nodes = checkpoint(nodes)
    rows = nodes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    buckets = checkpoint(rows.join(shared, "bucket").select("bucket", "center", "rep", "n", "m"))
    sizes = buckets.filter("rep = center").select(F.col("bucket").alias("c_bucket"), F.col("n").alias("n_c")).distinct()
    stars = (
        buckets.filter("rep <> center").join(sizes, F.col("bucket") == F.col("c_bucket"))
        .filter(_similar_size(p, "n", "n_c"))
        .select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    )
    stars = checkpoint(stars)
    members = buckets.select("rep").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(small_side(members.withColumnRenamed("rep", "id"), 24), "id")
    known = nodes.select(F.col("rep").alias("id"), "h1", "h2", "n", "bands")
    whole = full_sets(texts, p, "id", "text").join(known, ["id", "h1", "h2"]).dropDuplicates(["id", "h1", "h2"])
    whole = checkpoint(whole.select("id", "n", "members", "bands"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return measured(pairs, whole).withColumn("linked", _linked(p))

    first = checkpoint(confirmed(stars))
    links = first.filter("linked").select("a", "b")
    label = checkpoint(connected_components(links))

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        look = label.select(F.col("node").alias(f"{name}_key"), F.col("component").alias(f"{name}_found"))
        return df.join(look, F.col(column) == F.col(f"{name}_key"), "left").withColumn(name, F.coalesce(f"{name}_found", column)).drop(f"{name}_key", f"{name}_found")

    distance = first.select(F.col("a").alias("center"), F.col("b").alias("rep"), F.expr("1D - shared / (n_a + n_b - shared)").alias("d"))
    placed = labelled(labelled(buckets, "rep", "comp"), "center", "c_comp").join(distance, ["center", "rep"], "left")
    # Without a measured distance the sizes' bound, or 0 for the centre itself, leaves d unknown.
    placed = placed.withColumn("d", F.when(F.col("rep") == F.col("center"), F.lit(0.0)).otherwise(F.col("d")))
    # Read four times below: made once, and its joins planned once, which the driver holds in memory.
    placed = checkpoint(placed.select("bucket", "center", "rep", "n", "m", "comp", "c_comp", "d"))
    outside = placed.filter("comp <> c_comp").select("bucket", "m", F.col("rep").alias("x"), F.col("comp").alias("x_comp"), F.col("n").alias("x_n"), F.col("d").alias("x_d"), F.col("c_comp").alias("x_c_comp"))
    limit = 1 - p.percent / 100 + 1e-9
    few = placed.filter(F.col("rep") != F.col("center")).filter(F.col("m") <= p.small).select("bucket", "rep", "comp", "c_comp", "n", "d")
    rest = (
        outside.drop("m").join(few, "bucket")
        .filter(F.col("x_comp") != F.col("comp"))
        .filter((F.col("comp") == F.col("c_comp")) | (F.col("x") < F.col("rep")))
        .filter(_similar_size(p, "n", "x_n"))
        .filter(F.coalesce(F.abs(F.col("d") - F.col("x_d")) <= limit, F.lit(True)))
        .select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")).distinct()
        .join(first.select("a", "b"), ["a", "b"], "left_anti")
    )
    # Only of buckets with a row outside are sets brought together.
    open_ = outside.filter(F.col("m") > p.small).select("bucket").distinct()
    crowded = placed.filter(F.col("m") > p.small).join(open_, "bucket", "left_semi").select("bucket", "rep", "comp", "d", (F.col("comp") != F.col("c_comp")).alias("outside"))
    tiled = _tiles(crowded.join(whole.withColumnRenamed("id", "rep"), "rep"), p)
    second = checkpoint(confirmed(checkpoint(rest)).filter("linked").select("a", "b").unionByName(checkpoint(tiled)))
    bridges = labelled(labelled(second, "a", "u"), "b", "v").select(F.col("u").alias("a"), F.col("v").alias("b"))
    merged = connected_components(bridges).select(F.col("node").alias("m_node"), F.col("component").alias("m_component"))
    final = labelled(nodes.select("h1", "h2", "n", "rep"), "rep", "comp").join(merged, F.col("comp") == F.col("m_node"), "left").select("h1", "h2", "n", F.coalesce("m_component", "comp").alias("component"))
    empty = F.col("n") == 0
    joined = sets.select("id", "n", "h1", "h2").join(final, ["h1", "h2", "n"], "left")
    component = F.when(empty | F.col("id").isNull(), F.col("id")).otherwise(F.col("component"))
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
