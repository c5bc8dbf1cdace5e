"""Byte-level BPE encoding and decoding by recursive queries, one database per task."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textnum as tn
from .common import modest_batches
from .pieces import IdCache, edges, expand, gather, spans

#: Rows that one recursive query may hold: it keeps those of all its steps until it ends.
ROWS = 2_000_000
#: Bytes whose merges one query begins; a longer word is a query of its own.
BYTES = 200_000
#: Words decoded by one query.
WORDS = 160_000
TEXT_BYTES = 4 << 20

#: The fixpoint: rows of (word, position, token, next position, next token). Each step joins adjacent
#: tokens to the merge table, and contracts the leftmost pair of least rank of each word that has one.
#: A word's rows at its last step are its tokens, or what the next query goes on from.
MERGE = """
WITH RECURSIVE t(step, word, pos, tok, nxt, ntok) AS (
    SELECT 0, word, pos, tok, nxt, ntok FROM letters
    UNION ALL
    SELECT r.step + 1, r.word, r.pos,
           CASE WHEN r.pos = b.pos THEN b.made ELSE r.tok END,
           CASE WHEN r.pos = b.pos THEN gone.nxt ELSE r.nxt END,
           CASE WHEN r.pos = b.pos THEN gone.ntok WHEN r.nxt = b.pos THEN b.made ELSE r.ntok END
    FROM t AS r
    JOIN (
        SELECT word, best % 4294967296 AS pos, best // 4294967296 AS made, second
        FROM (
            SELECT t.word, min(m.made * 4294967296 + t.pos) AS best, arg_min(t.nxt, m.made * 4294967296 + t.pos) AS second
            FROM t JOIN merges AS m ON m.pair = t.tok * 65536 + t.ntok
            WHERE t.nxt >= 0 AND t.step < $steps
            GROUP BY t.word
        )
    ) AS b ON b.word = r.word
    JOIN t AS gone ON gone.pos = b.second
    WHERE r.pos <> b.second
)
SELECT t.step, t.word, t.pos, t.tok, t.nxt, t.ntok
FROM t JOIN (SELECT word, max(step) AS step FROM t GROUP BY word) AS last USING (word, step)
ORDER BY t.pos
"""

#: The same for long words, whose rows also have the token before: all pairs of least rank go in one
#: step, from the left, every other one of those that overlap. That is the same as one by one, unless a
#: contraction makes a pair of lower rank (``lower`` holds all such pairs): then only the leftmost goes.
MERGE_LONG = """
WITH RECURSIVE t(step, word, pos, tok, nxt, ntok, ptok) AS (
    SELECT 0, word, pos, tok, nxt, ntok, ptok FROM letters
    UNION ALL
    (
    WITH found AS (
        SELECT t.word, t.pos, t.nxt, t.ptok, m.made, min(m.made) OVER (PARTITION BY t.word) AS least
        FROM t JOIN merges AS m ON m.pair = t.tok * 65536 + t.ntok
        WHERE t.nxt >= 0 AND t.step < $steps
    ),
    numbered AS (
        SELECT *, row_number() OVER w AS rn, coalesce(lag(nxt) OVER w <> pos, true) AS fresh
        FROM found WHERE made = least WINDOW w AS (PARTITION BY word ORDER BY pos)
    ),
    apart AS (
        SELECT n.word, n.pos, n.made, n.rn, n.nxt AS second, g.nxt AS after, g.ntok,
               EXISTS (FROM lower AS x WHERE x.pair = n.ptok * 65536 + n.made) OR EXISTS (FROM lower AS x WHERE x.pair = n.made * 65536 + g.ntok)
               OR EXISTS (FROM lower AS x WHERE x.pair = n.made * 65536 + n.made) AS risky
        FROM (SELECT *, (rn - max(CASE WHEN fresh THEN rn END) OVER (PARTITION BY word ORDER BY pos)) % 2 = 0 AS turn FROM numbered) AS n
        JOIN t AS g ON g.pos = n.nxt
        WHERE n.turn
    ),
    chosen AS (
        SELECT * FROM apart QUALIFY rn = 1 OR NOT bool_or(risky) OVER (PARTITION BY word)
    )
    SELECT r.step + 1, r.word, r.pos, coalesce(own.made, r.tok),
           CASE WHEN own.pos IS NULL THEN r.nxt ELSE own.after END,
           coalesce(next.made, CASE WHEN own.pos IS NULL THEN r.ntok ELSE own.ntok END), coalesce(before.made, r.ptok)
    FROM t AS r
    SEMI JOIN chosen AS hit ON hit.word = r.word
    LEFT JOIN chosen AS own ON own.pos = r.pos
    LEFT JOIN chosen AS next ON next.pos = CASE WHEN own.pos IS NULL THEN r.nxt ELSE own.after END
    LEFT JOIN chosen AS before ON before.after = r.pos
    ANTI JOIN chosen AS gone ON gone.second = r.pos
    )
)
SELECT t.step, t.word, t.pos, t.tok, t.nxt, t.ntok, t.ptok
FROM t JOIN (SELECT word, max(step) AS step FROM t GROUP BY word) AS last USING (word, step)
ORDER BY t.pos
"""
#: Bytes of a long word.
LONG = 256

#: Decoding: the bytes of a word's tokens, aggregated in order.
DECODE = """
SELECT word, unhex(string_agg(v.hex, '' ORDER BY i.pos)) AS bytes
FROM ids AS i JOIN vocabulary AS v USING (tok)
GROUP BY word ORDER BY word
"""


class ByteBPE:
    """The merge table of a rank file, in a database in memory."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pairs = [
            (self.ranks[token[:k]] << 16 | self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items() for k in range(1, len(token)) if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self.letter = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        #: Whether a token may join the second and third of four bytes in a row (256: none): one that
        #: does is these two, or holds them with the byte before or after.
        self.two = np.zeros((257, 257), bool)
        self.three = np.zeros((257, 257, 257), bool)
        for token in self.ranks:
            if len(token) == 2:
                self.two[token[0], token[1]] = True
            for i in range(len(token) - 2):
                self.three[token[i], token[i + 1], token[i + 2]] = True
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        made = pd.DataFrame(pairs, columns=["pair", "made"])
        vocabulary = pd.DataFrame({"tok": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]})
        self.db.register("made", made)
        self.db.execute("CREATE TABLE merges AS SELECT pair, made FROM made")
        self.db.execute("CREATE TABLE lower AS SELECT pair FROM made WHERE made < greatest(pair // 65536, pair % 65536)")
        self.db.register("given", vocabulary)
        self.db.execute("CREATE TABLE vocabulary AS SELECT tok, hex FROM given")
        self.db.unregister("made")
        self.db.unregister("given")

    def parts(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' bytes end to end, and where a word begins or no token reaches across."""
        flat = gather(raw, starts, size)
        n = len(flat)
        wide = np.full(n + 3, 256, np.int64)
        wide[1 : n + 1] = flat
        first = np.zeros(n + 1, bool)
        first[np.cumsum(size) - size] = True
        first[n] = True
        x, y = wide[1 : n + 1], wide[2 : n + 2]
        w = np.where(first[:n], 256, wide[:n])
        z = np.where(np.append(first[2:], True), 256, wide[3:])
        joined = self.two[x, y] | self.three[w, x, y] | self.three[x, y, z]
        begin = first[:n].copy()
        begin[1:] |= ~joined[:-1]
        return flat, np.flatnonzero(begin)

    def encode(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words raw[start:end], end to end, and how many each has."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        data = raw.tobytes() if len(starts) else b""
        found = np.fromiter((self.ranks.get(data[a:b], -1) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
        whole = np.flatnonzero(found >= 0)
        counts[whole] = 1
        parts.append((whole, found[whole]))
        size = ends - starts
        rest = np.flatnonzero((found < 0) & (size > 0))
        if len(rest):
            ids, n = self.split_encode(raw, starts[rest], size[rest])
            counts[rest] = n
            parts.append((rest, ids))
        out = np.empty(int(counts.sum()), np.uint32)
        to = np.cumsum(counts) - counts
        for words, ids in parts:
            c = counts[words]
            out[np.repeat(to[words] - (np.cumsum(c) - c), c) + np.arange(len(ids))] = ids
        return out, counts

    def split_encode(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are no token: cut where no token can reach across, each distinct piece merged once."""
        flat, cuts = self.parts(raw, starts, size)
        ends = np.append(cuts[1:], len(flat))
        _, pick, code = tn.distinct_spans(flat, cuts, ends)
        begin, length = cuts[pick], (ends - cuts)[pick]
        n = np.zeros(len(pick), np.int64)
        each: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(length, kind="stable")
        edge = edges(length[order])
        lo = 0
        while lo < len(order):
            hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + BYTES, "right")) - 1)
            if length[order[lo]] <= LONG:
                hi = min(hi, int(np.searchsorted(length[order], LONG, "right")))
            some = order[lo:hi]
            word, tok = self.fixpoint(flat, begin[some], length[some])
            n[some] = np.bincount(word, minlength=len(some))
            each.append((some, tok))
            lo = hi
        ids = np.empty(int(n.sum()), np.uint32)
        to = np.cumsum(n) - n
        for some, tok in each:
            c = n[some]
            ids[np.repeat(to[some] - (np.cumsum(c) - c), c) + np.arange(len(tok))] = tok
        per_word = np.diff(np.searchsorted(cuts, np.append(np.cumsum(size) - size, len(flat))))
        return expand(ids, n, code, per_word)

    def fixpoint(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces, by recursive queries of so many steps each that their rows are bounded."""
        word = np.repeat(np.arange(len(size)), size)
        tok = self.letter[gather(raw, starts, size)]
        pos = np.arange(len(word))
        last = np.cumsum(size) - 1
        nxt, ntok = pos + 1, np.append(tok[1:], -1)
        nxt[last], ntok[last] = -1, -1
        state, query = {"word": word, "pos": pos, "tok": tok, "nxt": nxt, "ntok": ntok}, MERGE
        if len(size) and int(size.max()) > LONG:
            state["ptok"], query = np.append(-1, tok[:-1]), MERGE_LONG
            state["ptok"][last + 1 - size] = -1
        done: list[tuple[np.ndarray, ...]] = []
        while len(state["word"]):
            steps = max(1, ROWS // len(state["word"]))
            self.db.register("letters", pa.table(state))
            got = self.db.execute(query, {"steps": steps}).fetchnumpy()
            self.db.unregister("letters")
            over = np.asarray(got["step"]) < steps
            done.append(tuple(np.asarray(got[c])[over] for c in ("pos", "word", "tok")))
            state = {c: np.asarray(got[c])[~over].astype(np.int64) for c in state}
        pos, word, tok = (np.concatenate([d[k] for d in done]) if done else np.empty(0, np.int64) for k in range(3))
        order = np.argsort(pos, kind="stable")
        return word[order], tok[order]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of words of these ids, end to end, and how many each has."""
        out, sizes = [], []
        edge = np.concatenate([[0], np.cumsum(counts)])
        for lo in range(0, len(counts), WORDS):
            hi = min(len(counts), lo + WORDS)
            part = ids[edge[lo] : edge[hi]].astype(np.int64)
            self.db.register("ids", pa.table({"word": np.repeat(np.arange(hi - lo), counts[lo:hi]), "pos": np.arange(len(part)), "tok": part}))
            got = self.db.sql(DECODE).to_arrow_table().column("bytes")
            self.db.unregister("ids")
            raw, offsets = tn.utf8(got)
            out.append(raw.copy())
            sizes.append(np.diff(offsets))
        return (np.concatenate(out), np.concatenate(sizes)) if out else (np.empty(0, np.uint8), np.empty(0, np.int64))


@lru_cache(1)
def byte_bpe(path: str) -> tuple[ByteBPE, IdCache, IdCache]:
    """One for each worker: the tables, and caches of words' ids and of their decoded bytes."""
    return ByteBPE(path), IdCache(32 << 20), IdCache(32 << 20)


def _split(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = tn.split_spaced(cp, offsets)
    return starts, np.append(starts[1:], len(cp)) if len(starts) else starts


def encode_decode(texts: list[str], path: str) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Ids of all texts, end to end, and how many each has; the decoded bytes likewise."""
    bpe, known, plain = byte_bpe(path)
    keys, raw, starts, ends, code, per_row = spans(texts, _split)
    flat, counts = known.ids(keys, raw, starts, ends, lambda new: bpe.encode(raw, starts[new], ends[new]))
    first = np.cumsum(counts) - counts
    back, sizes = plain.ids(keys, raw, starts, ends, lambda new: bpe.decode(gather(flat, first[new], counts[new]), counts[new]))
    return expand(flat, counts, code, per_row), expand(back, sizes, code, per_row)


def bpe_round_trip(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``id_col, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``).

    Words (matches of the public split pattern) are encoded separately by the rank file, without
    special tokens. Each task's database merges its distinct words by a recursive query; a cache of
    bounded size keeps words from batch to batch. ``ids_sha256`` is over little-endian 32-bit ids.
    There is no shuffle. Words are told apart by their bytes.

    Words that are no token are first cut where no token of the file holds both sides of the cut, for
    no merge reaches across. Every query holds a bounded number of rows: it stops after so many steps,
    and the next one goes on. In pieces of over ``LONG`` bytes all pairs of one rank go in one step.

    Null and empty texts have no ids. Very long texts and words are encoded whole. Repeated rows and
    null ids are returned as they come; an empty table gives an empty result. Other columns are
    ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = tn.utf8(batch.column(1))
            for lo, hi in tn.row_ranges(offsets, TEXT_BYTES):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                (ids, n), (raw, size) = encode_decode(texts, rank_path)
                at, to = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(size)])
                view, data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B"), memoryview(raw)
                cols = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(n.astype(np.int64)),
                    pa.array([hashlib.sha256(view[4 * a : 4 * b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)], pa.string()),
                ]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        tn.trim()

    modest_batches(docs)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(id_col, text_col).mapInArrow(run, schema)
