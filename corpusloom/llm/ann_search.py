"""Approximate nearest neighbours by an inverted file with adaptive dimension scans."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint, modest_batches


@dataclass(frozen=True)
class AnnParams:
    """``sample`` rows at most are fitted (centroids); every row is indexed. ``check`` queries at most are
    compared with all rows to choose how many lists to probe for a recall of ``recall``. ``block``
    columns are read between tests, each of which errs on the side of keeping by ``slack`` standard
    deviations. ``tile`` rows of a list meet at most ``tile_queries`` queries in a task's step."""

    k: int = 20
    sample: int = 20_000
    max_lists: int = 4096
    rounds: int = 8
    check: int = 64
    recall: float = 0.97
    block: int = 16
    slack: float = 2.1
    tile: int = 2048
    tile_queries: int = 128
    seed: int = 3


@dataclass
class Index:
    """What the driver keeps: a rotation, centroids (both of bounded size) and the largest norm.

    Vectors get one more component, so that all have the largest norm: then the largest inner
    product is the least distance. They are rotated, so that any block of columns is a fair sample.
    """

    rotation: np.ndarray
    centroids: np.ndarray
    norm: float
    probes: int
    sizes: np.ndarray

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm**2 - (x**2).sum(axis=1)))
        return np.column_stack([x, rest]) @ self.rotation

    def lists(self, x: np.ndarray) -> np.ndarray:
        return _distances(x, self.centroids).argmin(axis=1)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ c.T + (c**2).sum(axis=1)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v`` (floats as they are, else doubles) of the rows that take part: no null, no component that
    is null or not finite, not all zero, and of the commonest dimension."""
    v = F.col(vec_col) if vectors.schema[vec_col].dataType.elementType == T.FloatType() else F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    inf = float("inf")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf))) & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (top["d"] if top else 0))


def _kmeans(x: np.ndarray, lists: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(rounds):
        own = _distances(x, c).argmin(axis=1)
        n = np.bincount(own, minlength=lists)
        sums = np.stack([np.bincount(own, x[:, j], lists) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), lists)])
    return c


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64, copy=False)


def _square(v: str):
    """The squared norm of a vector column, in doubles."""
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def build(rows: DataFrame, n_rows: int, p: AnnParams) -> tuple[Index, DataFrame]:
    """Fit on a bounded sample by hash, then assign every row to its list: ``list, id, v``."""
    rng = np.random.default_rng(p.seed)
    norm = math.sqrt(rows.agg(F.max(_square("v"))).first()[0])
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(p.sample).select("v").collect()
    x = np.array([r["v"] for r in chosen], dtype=np.float64)
    d = x.shape[1] + 1
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    index = Index(rotation, np.empty((0, d)), norm, 1, np.empty(0))
    lists = int(min(p.max_lists, max(1, math.isqrt(n_rows) // 2), len(x)))
    index.centroids = _kmeans(index.turned(x, query=False), lists, p.rounds, rng)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = index.lists(index.turned(_matrix(batch.column(1)), query=False))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), batch.column(0), batch.column(1)], names=["list", "id", "v"])

    placed = checkpoint(rows.select("id", "v").mapInArrow(run, T.StructType([T.StructField("list", T.IntegerType()), *rows.select("id", "v").schema])))
    sizes = np.zeros(lists)
    for r in placed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    index.sizes = sizes
    return index, placed


def exact(placed: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """``query_id, list, id, score``: the k nearest rows of a bounded set of queries among all rows, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, number = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            score = queries @ _matrix(batch.column(2)).T
            score[ids[:, None] == own[None, :]] = -np.inf
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            q = np.repeat(np.arange(len(ids)), top.shape[1])
            top = top.reshape(-1)
            keep = np.isfinite(score[q, top])
            q, top = q[keep], top[keep]
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(number[top]), pa.array(own[top]), pa.array(score[q, top])], names=["query_id", "list", "id", "score"])

    found = placed.select("list", "id", "v").mapInArrow(run, "query_id long, list int, id long, score double")
    return nearest(found, k)


def nearest(found: DataFrame, k: int) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", turn).filter(F.col("rank") <= k)


def calibrate(index: Index, placed: DataFrame, queries: DataFrame, p: AnnParams) -> float:
    """Choose the fewest probed lists that hold a share ``recall`` of the true neighbours of some queries."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(p.check).collect()
    if not some:
        return 1.0
    q, ids = np.array([r["v"] for r in some], dtype=np.float64), np.array([r["id"] for r in some])
    true = exact(placed, q, ids, p.k).select("query_id", "list").collect()
    order = np.argsort(_distances(index.turned(q, query=True), index.centroids), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
    row = {int(i): n for n, i in enumerate(ids)}
    depth = np.sort([place[row[r["query_id"]], r["list"]] for r in true]) if true else np.zeros(1, int)
    index.probes = int(depth[min(len(depth) - 1, math.ceil(p.recall * len(depth)))]) + 1
    return float((depth < index.probes).mean())


def scan(rows: np.ndarray, query: np.ndarray, near: float, p: AnnParams, norm2: float, k: int) -> np.ndarray:
    """Rows of a list that the hypothesis tests do not abandon, given the k-th least distance so far.

    After each block of columns a row's distance over d of D rotated columns is scaled by D / d; the
    hypothesis that its whole distance is under ``near`` is rejected if the estimate exceeds it by
    the factor (1 + slack / sqrt(d))**2.
    """
    alive = np.arange(len(rows))
    part = np.zeros(len(rows))
    dims = rows.shape[1]
    for at in range(0, dims, p.block):
        to = min(dims, at + p.block)
        part = part + ((rows[alive, at:to] - query[at:to]) ** 2).sum(axis=1)
        if to == dims:
            keep = part <= near * (1 + 1e-9) + 1e-12 * norm2
        else:
            keep = part * (dims / to) <= near * (1 + p.slack / math.sqrt(to)) ** 2
        alive, part = alive[keep], part[keep]
        if not len(alive):
            break
    return alive


def _tiles(index: Index, placed: DataFrame, probes: DataFrame, p: AnnParams) -> DataFrame:
    """``query_id, id, score``: each probed list's rows, dealt into tiles, against its queries, dealt too.

    Rows are dealt by their place in the written table, so that repeats of one id spread; a list's rows
    and queries are rotated where they meet.
    """

    def dealt(df: DataFrame, name: str, size: int, cols: list[str]) -> DataFrame:
        parts = df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("parts"))
        part = F.pmod(F.xxhash64("place"), F.col("parts"))
        return df.join(F.broadcast(parts), "list").groupBy("list", part.alias("part")).agg(F.collect_list(F.struct(*cols)).alias(name)).select("list", name)

    rows = placed.withColumn("place", F.monotonically_increasing_id())
    tiles = dealt(rows, "rows", p.tile, ["id", "v"]).join(dealt(probes.withColumn("place", F.col("id")), "queries", p.tile_queries, ["id", "v", "near"]), "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for i in range(batch.num_rows):
                rows, queries = batch.column(1)[i].values, batch.column(2)[i].values
                ids, v = rows.field("id").to_numpy(), _matrix(rows.field("v"))
                q_ids, q_v = queries.field("id").to_numpy(), _matrix(queries.field("v"))
                r, q_r = index.turned(v, query=False), index.turned(q_v, query=True)
                limits = queries.field("near").to_numpy(zero_copy_only=False)
                norm2 = float((r[0] ** 2).sum())
                for n in range(len(q_ids)):
                    near = limits[n]
                    if not np.isfinite(near) and len(ids) > 4 * p.k:
                        # No limit yet: the first rows give one.
                        first = np.partition(((r[: 4 * p.k] - q_r[n]) ** 2).sum(axis=1), p.k)[p.k]
                        near = float(first)
                    alive = scan(r, q_r[n], near, p, norm2, p.k)
                    alive = alive[ids[alive] != q_ids[n]]
                    score = v[alive] @ q_v[n]
                    if len(alive) > p.k:
                        order = np.lexsort([ids[alive], -score])[: p.k]
                        alive, score = alive[order], score[order]
                    out.append((np.full(len(alive), q_ids[n]), ids[alive], score))
            cols = [np.concatenate([o[c] for o in out]) if out else np.empty(0) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.float64))], names=["query_id", "id", "score"])

    return tiles.select("list", "rows", "queries").mapInArrow(run, "query_id long, id long, score double")


RESULT = "query_id long, rank int, vec_id long, score double"


def search(vectors: DataFrame, is_query, params: AnnParams | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k rows of largest inner product with each query row: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the query's own.
    Centroids are fitted on a bounded sample; all rows are indexed; the number of probed lists is
    calibrated against a full scan for a bounded set of queries. A query's nearest list gives it a
    first limit; its other lists are then scanned in blocks of rotated columns, and rows abandoned by
    hypothesis tests. Scores are inner products of the original vectors in double precision; equal
    scores go by smaller id. A query probes on until its lists hold more than k rows.

    Rows whose vector is null, zero, or has null or non-finite components take no part, nor do rows of
    a null id or of another length than the commonest. Repeated rows are candidates each; repeats of
    the query's own id are not its candidates, and of several vectors of a query's id the least asks. A list that holds many rows is dealt into tiles. An
    empty table gives an empty result. Other columns are ignored.
    """
    p = params or AnnParams()
    spark = vectors.sparkSession
    modest_batches(vectors)
    rows = checkpoint(usable(vectors, id_col, vec_col))
    n_rows = rows.count()
    if not n_rows:
        return spark.createDataFrame([], RESULT)
    index, placed = build(rows, n_rows, p)
    queries = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    calibrate(index, placed, queries, p)
    enough = 2 * p.k + 1

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r = index.turned(_matrix(batch.column(1)), query=True)
            order = np.argsort(_distances(r, index.centroids), axis=1, kind="stable")
            held = np.cumsum(index.sizes[order], axis=1)
            n = np.maximum(index.probes, 1 + (held <= enough).sum(axis=1)).clip(max=order.shape[1])
            q = np.repeat(np.arange(len(n)), n)
            turn = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(order[q, turn].astype(np.int32)), pa.array(turn.astype(np.int32)), batch.column(0).take(pa.array(q)), batch.column(1).take(pa.array(q))], names=["list", "turn", "id", "v"])

    probes = queries.select("id", "v").mapInArrow(choose, T.StructType([T.StructField("list", T.IntegerType()), T.StructField("turn", T.IntegerType()), *rows.select("id", "v").schema]))
    first = probes.filter("turn = 0").withColumn("near", F.lit(float("inf")))
    found = checkpoint(_tiles(index, placed, first, p))
    norm2 = index.norm**2
    # The k-th score so far, as a squared distance between augmented vectors.
    limit = nearest(found, p.k).groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= p.k)
    rest = probes.filter("turn > 0").join(limit, F.col("id") == F.col("query_id"), "left").withColumn("near", F.coalesce(_square("v") + F.lit(norm2) - 2 * F.col("least"), F.lit(float("inf"))))
    more = _tiles(index, placed, rest.select("list", "id", "v", "near"), p)
    best = nearest(found.unionByName(more), p.k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
