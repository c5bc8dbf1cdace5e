"""Which of many strings each text of a batch contains, exactly: windows of bytes propose, all bytes decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Positions of text looked at in one step; some 60 bytes of memory for each.
STEP = 1 << 20
#: Bytes compared in one step where strings are long.
COMPARE = 1 << 24
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _windows(data: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` (1, 2, 4 or 8) bytes from each position on, as one number."""
    w, size = data.astype(np.uint64), 1
    while size < width:
        w = w[:-size] | (w[size:] << np.uint64(8 * size))
        size *= 2
    return w


class Substrings:
    """A set of distinct strings. They are known by length, and by their first and last 1, 2, 4 or 8 bytes, of
    which the first is looked for at every position; what lies between is compared only behind both."""

    def __init__(self, strings: list[str]):
        coded = [s.encode() for s in strings]
        self.n = len(coded)
        self.empty = [i for i, s in enumerate(coded) if not s]
        self.longest = max(map(len, coded), default=0)
        self.classes = []
        for width in (1, 2, 4, 8):
            own = [i for i, s in enumerate(coded) if width <= len(s) < (2 * width if width < 8 else 1 << 62)]
            if not own:
                continue
            first = np.array([int.from_bytes(coded[i][:width], "little") for i in own], np.uint64)
            seen = np.zeros(1 << _BITS, bool)
            seen[self._slot(first)] = True
            by_length = []
            for size in sorted({len(coded[i]) for i in own}):
                rows = [k for k, i in enumerate(own) if len(coded[i]) == size]
                last = np.array([int.from_bytes(coded[own[k]][-width:], "little") for k in rows], np.uint64)
                ends = self._ends(first[rows], last)
                order = np.argsort(ends, kind="stable")
                bytes_ = np.frombuffer(b"".join(coded[own[rows[o]]] for o in order), np.uint8).reshape(len(rows), size)
                by_length.append((size, ends[order], np.array([own[rows[o]] for o in order]), bytes_))
            self.classes.append((width, seen, by_length))

    @staticmethod
    def _slot(w: np.ndarray) -> np.ndarray:
        return (w * _MIX) >> np.uint64(64 - _BITS)

    @staticmethod
    def _ends(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (first * _MIX) ^ ((last ^ (last >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))

    def held(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row of the text and index of the string, once for each pair; null texts hold nothing."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        start, stop = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(texts.buffers()[2], np.uint8)[start:stop] if stop > start else np.zeros(0, np.uint8)
        offsets = offsets - start
        real = np.flatnonzero(~texts.is_null().to_numpy(zero_copy_only=False))
        found = [np.repeat(real, len(self.empty)) * self.n + np.tile(np.array(self.empty, np.int64), len(real))]
        for at in range(0, len(data), STEP):
            piece = data[at : at + STEP + self.longest + 7]
            piece = np.concatenate([piece, np.zeros(8, np.uint8)])
            here = [np.unique(x) for width, seen, by_length in self.classes for x in self._found(piece, min(STEP, len(data) - at), at, offsets, width, seen, by_length)]
            found += here
        codes = np.unique(np.concatenate(found))
        return codes // max(1, self.n), codes % max(1, self.n)

    def _found(self, piece, count, at, offsets, width, seen, by_length):
        w = _windows(piece, width)
        spots = np.flatnonzero(seen[self._slot(w[:count])])
        if not len(spots):
            return
        row = np.searchsorted(offsets, spots + at, side="right") - 1
        room = offsets[row + 1] - at - spots
        for size, ends, index, bytes_ in by_length:
            fits = np.flatnonzero(room >= size)
            spot = spots[fits]
            key = self._ends(w[spot], w[spot + size - width])
            lo = np.searchsorted(ends, key)
            hit = np.flatnonzero(ends[np.minimum(lo, len(ends) - 1)] == key)
            # Strings of equal ends lie side by side; each is compared in its turn.
            lo, spot, own = lo[hit], spot[hit], row[fits[hit]]
            while len(lo):
                same = np.empty(len(lo), bool)
                most = max(1, COMPARE // size)
                for k in range(0, len(lo), most):
                    same[k : k + most] = (piece[spot[k : k + most, None] + np.arange(size)] == bytes_[lo[k : k + most]]).all(axis=1)
                yield own[same] * self.n + index[lo[same]]
                more = np.flatnonzero(~same & (lo + 1 < len(ends)) & (ends[np.minimum(lo + 1, len(ends) - 1)] == ends[lo]))
                lo, spot, own = lo[more] + 1, spot[more], own[more]
