"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnum as tn
from .common import checkpoint, modest_batches
from .pieces import IdCache, PairMerges, pair_merges, span_ids

CAPACITY = 2048
#: Bytes of text tokenised at once by a task.
TEXT_BYTES = 4 << 20
_cache: dict[str, IdCache] = {}


def normal(text: str, library) -> str:
    """The tokenizer's normal form: NFC, then lower case of each character by itself."""
    if text.isascii():
        return text.lower()
    if max(text) < "ɐ":
        import unicodedata

        return unicodedata.normalize("NFC", text).lower()
    return library.normalizer.normalize_str(text)


def cut(flat: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Pieces of documents of these many ids: document number, piece, start, length, CRC-32 of the ids."""
    n_pieces = -(-counts // capacity)
    doc = np.repeat(np.arange(len(counts)), n_pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    start = piece * capacity
    length = np.minimum(capacity, counts[doc] - start)
    begin = (np.cumsum(counts) - counts)[doc] + start
    view = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
    crc = np.array([zlib.crc32(view[4 * b : 4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)], np.int64)
    return doc, piece, start, length, crc


def text_ids(texts: list[str], merges: PairMerges, cache: IdCache, added_tokens: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each ended by id 0, and how many each has."""
    if not added_tokens:
        return span_ids([normal(t, merges.library) for t in texts], tn.split_plain, cache, merges.encode, extra=True)
    parts, ends, n_parts = [], [], []
    for text in texts:  # each part has one id after it: an added token's, or the last 0
        own, ids = merges.at_added(text)
        parts += own
        ends += [*ids, 0]
        n_parts.append(len(own))
    flat, counts = span_ids([normal(t, merges.library) for t in parts], tn.split_plain, cache, merges.encode, extra=True)
    flat[np.cumsum(counts) - 1] = ends
    return flat, np.add.reduceat(counts, np.cumsum(n_parts) - n_parts)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, added_tokens: bool) -> DataFrame:
    """A row per piece: uid (unique), doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = pair_merges(tokenizer_path)
        cache = _cache.setdefault(tokenizer_path, IdCache(16 << 20))
        for batch in batches:
            _, offsets = tn.utf8(batch.column(1))
            for lo, hi in tn.row_ranges(offsets, TEXT_BYTES):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                flat, counts = text_ids(texts, merges, cache, added_tokens)
                doc, piece, start, length, crc = cut(flat, counts, capacity)
                ids = batch.column(0).slice(lo, hi - lo).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids, pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        tn.trim()

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return docs.select(id_col, text_col).mapInArrow(run, schema).withColumn("uid", F.monotonically_increasing_id())


# ---- The genetic algorithm -----------------------------------------------------------------------


class Bins:
    """Open bins by free space, with the fullest bin that still fits found by bit tricks."""

    def __init__(self, capacity: int):
        self.capacity, self.stacks, self.mask = capacity, [[] for _ in range(capacity + 1)], 0

    def add(self, bin_: int, free: int) -> None:
        if free > 0:
            self.stacks[free].append(bin_)
            self.mask |= 1 << free

    def fit(self, size: int) -> tuple[int, int]:
        """Take out the bin of least free space that holds size: (bin, its free space), or (-1, 0)."""
        rest = self.mask >> size
        if not rest:
            return -1, 0
        free = size + (rest & -rest).bit_length() - 1
        stack = self.stacks[free]
        bin_ = stack.pop()
        if not stack:
            self.mask &= ~(1 << free)
        return bin_, free


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, free: dict[int, int], capacity: int) -> None:
    """Put items, in the order given, each into the fullest bin that fits; bins gets their numbers."""
    open_ = Bins(capacity)
    for b, f in free.items():
        open_.add(b, f)
    fresh = max(free, default=-1) + 1
    for item, size in zip(items.tolist(), sizes[items].tolist(), strict=True):
        bin_, space = open_.fit(size)
        if bin_ < 0:
            bin_, space, fresh = fresh, capacity, fresh + 1
        bins[item] = bin_
        open_.add(bin_, space - size)


def loads(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes).astype(np.int64)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then fuller ones (the sum of squared fills); larger is better."""
    fill = loads(sizes, bins)
    fill = fill[fill > 0]
    return -len(fill), float(((fill / capacity) ** 2).sum())


def cross(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject some of the giver's well-filled bins whole; the taker's bins that share an item go, and
    what only they held is best-fitted again, largest first."""
    fill = loads(sizes, giver)
    full = np.flatnonzero(fill >= np.quantile(fill[fill > 0], 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(full, max(1, len(full) // 6), replace=False)] = True
    inside = chosen[giver]
    broken = np.zeros(int(taker.max()) + 1, bool)
    broken[taker[inside]] = True
    poor = loads(sizes, taker)
    held = np.flatnonzero((poor > 0) & ~broken)
    if len(held):  # mutation: the emptiest bins and a few others are opened too
        broken[held[np.argsort(poor[held])[: max(2, len(held) // 50)]]] = True
        broken[rng.choice(held, max(1, len(held) // 100), replace=False)] = True
    child = taker.copy()
    names = np.full(len(fill), -1, np.int64)
    names[chosen] = len(broken) + np.arange(int(chosen.sum()))
    child[inside] = names[giver[inside]]
    out = np.flatnonzero(broken[taker] & ~inside)
    keep = np.ones(len(child), bool)
    keep[out] = False
    live, number = np.unique(child[keep], return_inverse=True)
    child[keep] = number
    free = dict(enumerate((capacity - np.bincount(number, sizes[keep])).astype(np.int64).tolist())) if len(live) else {}
    best_fit(sizes, out[np.argsort(-sizes[out], kind="stable")], child, free, capacity)
    return child


def evolve(sizes: np.ndarray, people: list[np.ndarray], capacity: int, rng: np.random.Generator, generations: int) -> list[np.ndarray]:
    """Each generation a child of two parents replaces the worst, unless no sequence can be saved."""
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(sizes, p, capacity), i, p) for i, p in enumerate(people)), key=lambda x: x[:2], reverse=True)
    for g in range(generations):
        if -scored[0][0][0] == least:
            break
        a, b = rng.choice(len(scored), 2, replace=False) if len(scored) > 1 else (0, 0)
        child = cross(sizes, scored[min(a, b)][2], scored[max(a, b)][2], capacity, rng)
        score = fitness(sizes, child, capacity)
        if score > scored[-1][0]:
            scored[-1] = (score, len(people) + g, child)
            scored.sort(key=lambda x: (x[0], -x[1]), reverse=True)
    return [p for _, _, p in scored]


def settle(sizes: np.ndarray, capacity: int, rng: np.random.Generator, count: int) -> list[np.ndarray]:
    """A first population: best-fit by size, with more and more noise in the order."""
    people = []
    for k in range(count):
        noisy = sizes * (1 + 0.05 * k * rng.random(len(sizes)))
        bins = np.zeros(len(sizes), np.int64)
        best_fit(sizes, np.argsort(-noisy, kind="stable"), bins, {}, capacity)
        people.append(bins)
    return people


@dataclass(frozen=True)
class Evolution:
    """``group_items``: items that compete for bins together, which bounds a task's memory.
    ``islands`` populations of ``people`` evolve for each group over ``epochs`` of ``generations``;
    after each epoch every island's elite moves on to the next island."""

    group_items: int = 8192
    islands: int = 2
    people: int = 3
    epochs: int = 2
    generations: int = 8
    seed: int = 7


ISLAND = "grp long, island int, uids binary, sizes binary, people array<binary>"


def _islands(groups: DataFrame, capacity: int, e: Evolution) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items = sorted((x["length"], x["uid"]) for x in row["items"])
                sizes = np.array([s for s, _ in items], np.int64)
                uids = np.array([u for _, u in items], np.int64)
                out = []
                for island in range(e.islands):
                    rng = np.random.default_rng([e.seed, row["grp"], island, 0])
                    people = settle(sizes, capacity, rng, e.people)
                    out.append({"grp": row["grp"], "island": island, "uids": uids.tobytes(), "sizes": sizes.astype(np.int16).tobytes(), "people": [p.astype(np.int32).tobytes() for p in people]})
                yield from _rows(out)

    return groups.mapInArrow(found, ISLAND)


_ISLAND_ARROW = pa.schema([("grp", pa.int64()), ("island", pa.int32()), ("uids", pa.binary()), ("sizes", pa.binary()), ("people", pa.list_(pa.binary()))])


def _rows(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_pylist(rows, schema=_ISLAND_ARROW).to_batches()


def _epoch(islands: DataFrame, capacity: int, e: Evolution, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rng = np.random.default_rng([e.seed, row["grp"], row["island"], epoch])
                sizes = np.frombuffer(row["sizes"], np.int16).astype(np.int64)
                people = [np.frombuffer(p, np.int32).astype(np.int64) for p in row["people"]]
                people = evolve(sizes, people, capacity, rng, e.generations)
                yield from _rows([row | {"people": [p.astype(np.int32).tobytes() for p in people]}])

    return islands.mapInArrow(run, ISLAND)


def _migrate(islands: DataFrame, e: Evolution) -> DataFrame:
    """Each island's best replaces the worst of the next island of the same group."""
    elites = islands.select("grp", ((F.col("island") + 1) % e.islands).cast("int").alias("island"), F.element_at("people", 1).alias("elite"))
    moved = islands.join(elites, ["grp", "island"])
    return moved.select("grp", "island", "uids", "sizes", F.concat(F.slice("people", 1, e.people - 1), F.array("elite")).alias("people"))


def _places(islands: DataFrame, capacity: int) -> DataFrame:
    """The best packing of each group as uid, sequence_id, offset."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        best = None
        for row in rows.sort_values("island").itertuples():
            sizes = np.frombuffer(row.sizes, np.int16).astype(np.int64)
            bins = np.frombuffer(row.people[0], np.int32).astype(np.int64)
            score = fitness(sizes, bins, capacity)
            if best is None or score > best[0]:
                best = score, sizes, bins, np.frombuffer(row.uids, np.int64)
        _, sizes, bins, uids = best
        order = np.argsort(bins, kind="stable")
        at = np.cumsum(sizes[order]) - sizes[order]
        first = np.concatenate([[True], np.diff(bins[order]) > 0])
        at = at - np.repeat(at[first], np.diff(np.append(np.flatnonzero(first), len(at))))
        return pd.DataFrame({"uid": uids[order], "sequence_id": (key[0] << 32) | bins[order], "offset": at})

    return islands.groupBy("grp").applyInPandas(run, "uid long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, evolution: Evolution | None = None, added_tokens: bool = True) -> DataFrame:
    """Pack documents into sequences of at most capacity (up to 32767) tokens.

    A document is its ids under the word-level BPE file, then id 0. Only a longer document is cut,
    into pieces of capacity tokens; its last piece may be shorter. Returns per piece ``id_col, piece,
    start, length, ids_crc32, sequence_id, offset``.

    The file's added tokens (such as <|endoftext|>) that a text spells out have their own ids, as the
    library gives them at its default setting with add_special_tokens=False. Without ``added_tokens``
    they are text like any other, as under the library's encode_special_tokens.

    A full piece is a sequence of its own. The others are dealt by hash into groups of about
    ``group_items``; a grouping genetic algorithm packs each group on several islands. One group's
    lengths (not its texts) are all that a task holds. The last sequence of each group may stay
    partly filled, a cost of under one sequence in ``group_items`` documents.

    Null and empty texts are one token, id 0. Repeated rows are packed as often as they occur; null
    ids are kept. A very long text is cut into many full pieces. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    e = evolution or Evolution()
    modest_batches(docs)
    pieces = checkpoint(tokenized_pieces(docs, tokenizer_path, id_col, text_col, capacity, added_tokens))
    whole = pieces.filter(F.col("length") == capacity)
    part = pieces.filter(F.col("length") < capacity)
    n_groups = max(1, -(-part.count() // e.group_items))
    groups = part.groupBy(F.pmod(F.xxhash64("uid"), F.lit(n_groups)).alias("grp")).agg(F.collect_list(F.struct("uid", "length")).alias("items"))
    conf = docs.sparkSession.conf
    tasks = max(4 * docs.sparkSession.sparkContext.defaultParallelism, int(conf.get("spark.sql.shuffle.partitions")))
    islands = _islands(groups, capacity, e).repartition(min(n_groups * e.islands, tasks), "grp", "island")
    for epoch in range(1, e.epochs + 1):
        islands = _epoch(islands, capacity, e, epoch)
        if epoch < e.epochs:
            islands = _migrate(islands, e)
    packed = part.join(_places(checkpoint(islands), capacity), "uid")
    cols = [F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32"]
    alone = whole.select(*cols, (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.select(*cols, "sequence_id", "offset").unionByName(alone)
