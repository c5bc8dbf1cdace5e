"""Whole batches of text as NumPy arrays: word boundaries, word hashes, regular splits.

Everything here runs on executors, over Arrow batches, and is bounded by the batch: work is done on
row ranges of about ``ROWS_BYTES`` bytes, a longer document forming a range of its own.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

ROWS_BYTES = 4 << 20
U64 = np.uint64


def trim() -> None:
    """Give memory that is free inside this worker back to the system; workers live on between tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


#: Seeds of independent hashes.
_LANES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Longer spans are hashed one by one: there are few of them for their bytes.
_LONG = 1024
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def _overlapping(codes: np.ndarray) -> np.ndarray:
    """The 8 bytes from every byte of codes on, as numbers; zeros stand after the last."""
    padded = np.zeros(codes.nbytes + 8, np.uint8)
    padded[:-8] = np.ascontiguousarray(codes).view(np.uint8)
    return np.ndarray(codes.nbytes + 1, "<u8", padded, 0, (1,))


def _spelled(codes: np.ndarray, start: int, size: int) -> bytes:
    return np.ascontiguousarray(codes).view(np.uint8)[start : start + size].tobytes()


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every span of codes; equal spans have equal hashes wherever they stand.

    Eight bytes at a time go through a scramble that is not linear, so no family of spans is known to
    collide, and spans of up to eight bytes of one size never do.
    """
    wide = codes.dtype.itemsize
    starts, size = starts * wide, (ends - starts) * wide
    h = mix(size.astype(U64) ^ U64(_LANES[lane]))
    view, at = _overlapping(codes), 0
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    while len(live):
        left = size[live] - at
        h[live] = mix(h[live] ^ (view[starts[live] + at] & _MASKS[np.minimum(left, 8)]))
        live = live[left > 8]
        at += 8
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(_spelled(codes, starts[i], size[i]), _LANES[lane])
    return h


def equal_spans(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Whether span i of a holds what span i of b holds, byte by byte."""
    wide = a.dtype.itemsize
    size = (a_ends - a_starts) * wide
    same = size == (b_ends - b_starts) * wide
    left, right, at = _overlapping(a), _overlapping(b), 0
    p, q = a_starts * wide, b_starts * wide
    live = np.flatnonzero(same & (size > 0) & (size <= _LONG))
    while len(live):
        rest = size[live] - at
        differ = ((left[p[live] + at] ^ right[q[live] + at]) & _MASKS[np.minimum(rest, 8)]) != 0
        same[live[differ]] = False
        live = live[~differ & (rest > 8)]
        at += 8
    for i in np.flatnonzero(same & (size > _LONG)).tolist():
        same[i] = _spelled(a, p[i], size[i]) == _spelled(b, q[i], size[i])
    return same


def distinct_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the distinct spans, the first place of each, and every span's number among them.

    Hashes only propose: every span is compared with the first of its hash, and one that differs gets
    a number of its own.
    """
    import pandas as pd

    code, keys = pd.factorize(span_hashes(codes, starts, ends))
    pick = np.empty(len(keys), np.int64)
    pick[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    first = pick[code]
    odd = np.flatnonzero(~equal_spans(codes, starts, ends, codes, starts[first], ends[first]))
    if len(odd):
        wide, more, known = codes.dtype.itemsize, [], {}
        for i in odd.tolist():
            word = _spelled(codes, starts[i] * wide, (ends[i] - starts[i]) * wide)
            if word not in known:
                known[word] = len(pick) + len(more)
                more.append((i, keys[code[i]]))
            code[i] = known[word]
        pick = np.append(pick, [i for i, _ in more])
        keys = np.append(keys, np.array([k for _, k in more], U64))
    return keys, pick, code


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64) if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_ranges(offsets: np.ndarray, limit: int = ROWS_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most limit bytes each, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of the rows, and how many each row has."""
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = (raw - np.uint8(9)) > 4
    solid &= raw != 0x20
    edge = offsets[(offsets > 0) & (offsets < n)]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    begin[edge] = solid[edge]
    final = solid.copy()
    final[:-1] &= ~solid[1:]
    final[edge - 1] = solid[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(final) + 1, np.diff(np.searchsorted(starts, offsets))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hashes of byte spans with A-Z as a-z."""
    return span_hashes(raw + (((raw - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)), starts, ends, lane)


def unique(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats hashing here."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


# ---- Splits by character class -------------------------------------------------------------------

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The Unicode White_Space characters.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = SPACE
    return out


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, and row offsets."""
    joined = "".join(texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)


def _contractions(cp: np.ndarray, start_ok: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of 's 't 're 've 'm 'll 'd where a match may begin, and their lengths."""
    at = np.flatnonzero((cp == 39) & start_ok)
    n = len(cp)
    x = np.where(at + 1 < n, cp[np.minimum(at + 1, n - 1)], 0)
    x[(at + 1 < n) & first[np.minimum(at + 1, n)]] = 0
    y = np.where(at + 2 < n, cp[np.minimum(at + 2, n - 1)], 0)
    y[(at + 2 < n) & first[np.minimum(at + 2, n)]] = 0
    s, t, m, d, r, v, l, e = (ord(c) for c in "stmdrvle")
    one = (x == s) | (x == t) | (x == m) | (x == d)
    two = ((x == r) & (y == e)) | ((x == v) & (y == e)) | ((x == l) & (y == l))
    size = np.where(one, 2, np.where(two, 3, 0))
    return at[size > 0], size[size > 0]


def split_spaced(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the matches of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

    The matches tile every row, so a match ends where the next begins.
    """
    n = len(cp)
    if not n:
        return np.empty(0, np.int64)
    kind = classes()[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    prev = np.empty(n, np.uint8)
    prev[0], prev[1:] = 255, kind[:-1]
    prev[first[:n]] = 255
    nxt = np.empty(n, np.uint8)
    nxt[-1], nxt[:-1] = 255, kind[1:]
    nxt[first[1:]] = 255
    blank = cp == 32
    begin = kind != prev
    before_blank = np.zeros(n, bool)
    before_blank[1:] = blank[:-1]
    before_blank &= prev == SPACE
    begin &= ~((kind != SPACE) & before_blank)  # the blank before a run belongs to it
    begin |= (kind == SPACE) & (nxt != SPACE) & (nxt != 255)  # the last space before a run stands apart
    at, size = _contractions(cp, (prev != OTHER) & ~before_blank, first)
    after = at + size
    after = after[after < n]
    begin[at] = True
    for k in (1, 2):  # what a contraction covers begins no match
        begin[at[size > k] + k] = False
    begin[after] |= kind[after] == LETTER
    begin[after] |= first[after]
    return np.flatnonzero(begin)


def split_plain(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``."""
    n = len(cp)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = classes()[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    prev = np.empty(n, np.uint8)
    prev[0], prev[1:] = 255, kind[:-1]
    prev[first[:n]] = 255
    begin = (kind != prev) | (kind == NUMBER)
    at, size = _contractions(cp, prev != OTHER, first)
    after = at + size
    after = after[after < n]
    for k in (1, 2):
        begin[at[size > k] + k] = False
    begin[after] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    keep = kind[starts] != SPACE
    return starts[keep], ends[keep]
