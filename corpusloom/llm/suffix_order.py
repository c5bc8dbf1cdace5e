"""Suffix order by difference-cover blockwise construction.

A difference cover of period v holds, for any two positions i and j, a d < v such that i + d and j + d
are both cover positions. So once the cover's suffixes are ranked, any two suffixes that agree on
their first v bytes are ordered by comparing two ranks. Suffixes are then sorted one bucket at a time:
beyond the text and the ranks of its cover sample, memory is that of one bucket.
"""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np

U64 = np.uint64
#: A perfect difference set modulo 31.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Suffixes sorted at once.
BUCKET = 1 << 18

_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True
#: The first step from each residue into the cover; and the common step of each pair of residues.
_STEP = np.array([next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD]) for r in range(PERIOD)])
_PAIR = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(r + d) % PERIOD] and _IN_COVER[(s + d) % PERIOD]) for s in range(PERIOD)] for r in range(PERIOD)])


def words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a big-endian number; text ends in at least 8 spare bytes."""
    return np.lib.stride_tricks.sliding_window_view(text, 8)[at].view(">u8").reshape(-1).astype(U64)


def _names(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by keys, first key first, and each row's number among distinct rows."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new)
    return order, name


class CoverRanks:
    """Ranks of the cover's suffixes, exact to ``depth`` bytes at least (whole suffixes if none is given)."""

    def __init__(self, text: np.ndarray, size: int, depth: int | None):
        classes = [np.arange(d, size + PERIOD, PERIOD) for d in COVER]
        self.first = np.zeros(PERIOD, np.int64)
        edge = np.concatenate([[0], np.cumsum([len(c) for c in classes])])
        self.first[list(COVER)] = edge[:-1]
        at = np.concatenate(classes)
        n = len(at)
        after = np.arange(1, n + 1)  # the sample one period on
        after[edge[1:] - 1] = n
        beyond = at >= size
        _, rank = _names([*(words_at(text, at + 8 * k) for k in range(4)), np.where(at + 32 > size, size - at, 33)])
        rank += 1
        rank[beyond] = 0
        reach = 32 - (32 % PERIOD)
        while reach < (depth or size) and len(np.unique(rank[~beyond])) < n - int(beyond.sum()):
            padded = np.append(rank, 0)
            _, rank = _names([rank, padded[after]])
            rank += 1
            rank[beyond] = 0
            nxt = np.append(after, n)
            after = nxt[after]
            reach *= 2
        self.rank = rank

    def at(self, positions: np.ndarray) -> np.ndarray:
        return self.rank[self.first[positions % PERIOD] + positions // PERIOD]


def suffix_order(text: np.ndarray, starts: np.ndarray, depth: int | None = None, bucket: int = BUCKET) -> np.ndarray:
    """The given suffixes of text (uint8) in order; with a depth, only that many bytes are certain to count.

    With a depth, suffixes that agree on 32 bytes go by residue modulo PERIOD, then by cover rank: so
    those equal to that depth stand together if they share a residue. Without one, ties of different
    residues are ordered by the ranks at their common step.
    """
    size = len(text)
    padded = np.concatenate([text, np.zeros(2 * PERIOD + 64, np.uint8)])
    ranks = CoverRanks(padded, size, depth)
    head = words_at(padded, starts)
    if len(starts) > bucket:
        probe = np.sort(head[:: max(1, len(head) // 65536)])
        splits = np.unique(probe[:: max(1, len(probe) * bucket // len(starts))])
        owner = np.searchsorted(splits, head, "right")
        by_owner = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[by_owner])) + 1
        parts = np.split(by_owner, cuts)
    else:
        parts = [np.arange(len(starts))]
    return np.concatenate([p[_sorted(padded, size, starts[p], ranks, depth is None)] for p in parts]) if len(starts) else np.empty(0, np.int64)


def _sorted(text: np.ndarray, size: int, at: np.ndarray, ranks: CoverRanks, whole: bool) -> np.ndarray:
    """One bucket: by the first 32 bytes, ties by the ranks of cover positions."""
    keys = [words_at(text, at + 8 * k) for k in range(4)]
    keys.append(np.where(at + 32 > size, size - at, 33))
    residue = at % PERIOD
    rank = ranks.at(at + _STEP[residue])
    order = np.lexsort([rank, residue, *keys[::-1]])
    if not whole:
        return order
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    # Ties between different residues: their common step orders them.
    r = residue[order]
    mixed = np.zeros(len(order), bool)
    mixed[1:] = (r[1:] != r[:-1]) & ~new[1:]
    if mixed.any():
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        ends = np.append(heads[1:], len(order))
        for g in np.unique(group[mixed]).tolist():
            own = order[heads[g] : ends[g]]
            lists = own.tolist()

            def compare(i: int, j: int) -> int:
                step = _PAIR[residue[i], residue[j]]
                pair = ranks.at(np.array([at[i] + step, at[j] + step]))
                return int(pair[0]) - int(pair[1]) or int(residue[i]) - int(residue[j])

            order[heads[g] : ends[g]] = sorted(lists, key=cmp_to_key(compare))
    return order
