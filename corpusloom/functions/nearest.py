"""The nearest vectors of each of a stated set, over batches: products propose, exact scores decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .vectors import cosines, norms

#: Stated vectors that meet a batch at once.
ROWS = 256
#: Pairs scored exactly at once.
PAIRS = 1 << 16
#: A product of unit vectors is nearer to its rounded cosine than this.
MARGIN = 2e-6
#: In place of a score, for the order: not a number comes first, null last, and an empty place after it.
NAN, NULL, NONE = 9.0, -2.0, -3.0
_NO_ID = np.iinfo(np.int64).max


def by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors (no nulls) as a matrix, for each length."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    out = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[int(size)] = rows, values[(ends[rows] - size)[:, None] + np.arange(size)]
    return out


class Nearest:
    """The k best of all batches seen, for each stated vector: score descending, then id."""

    def __init__(self, stated: pa.Array, k: int):
        n = self.n = len(stated)
        self.k = k
        self.groups = [(size, rows, x, norms(x)) for size, (rows, x) in by_length(stated).items()]
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), _NO_ID)
        self.note = np.full((n, k), None, object)

    def add(self, ids: np.ndarray, column: pa.Array, notes: np.ndarray) -> None:
        """Vectors with ids and a note that goes with each."""
        there = {size: (rows, y, norms(y)) for size, (rows, y) in by_length(column).items()}
        for size, own, x, nx in self.groups:
            rows, y, ny = there.get(size, (np.zeros(0, np.int64), np.zeros((0, size)), np.zeros(0)))
            # A zero vector's scores are null, but not a number against one whose length is none.
            usual, zero = np.isfinite(nx) & (nx != 0), nx == 0
            for some, live in ((usual, ny != 0), (zero, ~np.isfinite(ny)), (~usual & ~zero, ny >= -1)):
                live = live | np.isnan(ny)
                mine = np.flatnonzero(some)
                other = self._least(ids, np.setdiff1d(np.arange(len(ids)), rows[live])) if len(mine) else None
                for at in range(0, len(mine), ROWS):
                    part = mine[at : at + ROWS]
                    if live.any():
                        self._scored(own[part], x[part], nx[part], rows[live], y[live], ny[live], ids, notes)
                    self._nulls(own[part], other, ids, notes)

    def _least(self, ids, rows):
        return rows[np.argsort(ids[rows], kind="stable")[: self.k]]

    def _nulls(self, own, rows, ids, notes) -> None:
        own = own[self.score[own, -1] <= NULL]
        if len(own) and len(rows):
            at, what = np.repeat(own, len(rows)), np.tile(rows, len(own))
            self._merge(at, np.full(len(at), NULL), ids[what], notes[what])

    def _scored(self, own, x, nx, rows, y, ny, ids, notes) -> None:
        with np.errstate(all="ignore"):
            s = (x / nx[:, None]) @ (y / ny[:, None]).T
        for n, axis in ((nx, 0), (ny, 1)):
            odd = np.flatnonzero(~((n > 1e-100) & (n < 1e100)))
            if len(odd):
                s[(odd,) if axis == 0 else (slice(None), odd)] = NAN
        s[np.isnan(s)] = NAN
        least = self.score[own, -1]
        if len(rows) > self.k and (s >= (least - MARGIN)[:, None]).sum() > 8 * self.k * len(own):
            least = np.maximum(least, np.partition(s, len(rows) - self.k, axis=1)[:, len(rows) - self.k])
        r, c = np.nonzero(s >= (np.where(least >= NAN, -1.0 - MARGIN, least) - MARGIN)[:, None])
        for at in range(0, len(r), PAIRS):
            i, j = r[at : at + PAIRS], c[at : at + PAIRS]
            with np.errstate(all="ignore"):
                score, null = cosines(x[i], y[j], nx[i], ny[j])
            score = np.where(null, NULL, np.where(np.isnan(score), NAN, score))
            keep = score >= self.score[own[i], -1]
            self._merge(own[i[keep]], score[keep], ids[rows[j[keep]]], notes[rows[j[keep]]])

    def _merge(self, at, score, ids, notes) -> None:
        touched = np.unique(at)
        at = np.concatenate([np.repeat(touched, self.k), at])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        notes = np.concatenate([self.note[touched].ravel(), notes])
        order = np.lexsort((ids, -score, at))
        first = np.searchsorted(at[order], touched)
        top = order[first[:, None] + np.arange(self.k)]
        self.score[touched], self.id[touched], self.note[touched] = score[top], ids[top], notes[top]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Stated row, score (``NULL`` and ``NAN`` in their places), id and note of what was found."""
        r, c = np.nonzero(self.score > NONE)
        return r, self.score[r, c], self.id[r, c], self.note[r, c]
