"""Ids of words: a bounded cache by word hash, and byte-pair merges of many words at once."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from . import textnum as tn

#: Values of the words of these numbers, end to end, and how many each has.
Encode = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + count], one after the other."""
    total = int(counts.sum())
    if not total:
        return flat[:0]
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    shift += np.arange(total)
    return flat[shift]


class IdCache:
    """Ids of words by 64-bit hash, kept from batch to batch in one worker; emptied beyond ``limit`` bytes.

    Words are kept too: a hash only proposes, and the bytes decide.
    """

    def __init__(self, limit: int = 48 << 20):
        self.limit = limit
        #: Sorted keys; words end to end, and their edges; ids end to end, and their edges.
        self.runs: list[tuple[np.ndarray, ...]] = []

    def ids(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode: Encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words raw[start:end] of these hashes, end to end, and how many each has."""
        n = len(keys)
        place, where = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for k, (own, spelt, edge, _, _) in enumerate(self.runs):
            open_ = np.flatnonzero(where < 0)
            at = np.searchsorted(own, keys[open_])
            at[at == len(own)] = 0
            hit = own[at] == keys[open_]
            open_, at = open_[hit], at[hit]
            same = tn.equal_spans(raw, starts[open_], ends[open_], spelt, edge[at], edge[at + 1])
            place[open_[same]], where[open_[same]] = at[same], k
        new = np.flatnonzero(where < 0)
        if len(new):
            order = new[np.argsort(keys[new])]
            flat, counts = encode(order)
            size = ends[order] - starts[order]
            place[order], where[order] = np.arange(len(order)), len(self.runs)
            self.runs.append((keys[order], gather(raw, starts[order], size), edges(size), flat, edges(counts)))
        counts = np.zeros(n, np.int64)
        for k, run in enumerate(self.runs):
            own, edge = where == k, run[4]
            counts[own] = edge[place[own] + 1] - edge[place[own]]
        out = np.empty(int(counts.sum()), self.runs[0][3].dtype if self.runs else np.int32)
        to = np.cumsum(counts) - counts
        for k, (_, _, _, flat, edge) in enumerate(self.runs):
            own = np.flatnonzero(where == k)
            c = counts[own]
            out[np.repeat(to[own] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))] = gather(flat, edge[place[own]], c)
        self._settle()
        return out, counts

    def _settle(self) -> None:
        if sum(x.nbytes for run in self.runs for x in run) > self.limit:
            self.runs = []
        while len(self.runs) > 1 and len(self.runs[-1][0]) * 3 > len(self.runs[-2][0]):
            (k1, w1, v1, f1, e1), (k2, w2, v2, f2, e2) = self.runs.pop(), self.runs.pop()
            keys = np.concatenate([k1, k2])
            order = np.argsort(keys)

            def both(x1, edge1, x2, edge2, order=order):
                counts = np.concatenate([np.diff(edge1), np.diff(edge2)])[order]
                starts = np.concatenate([edge1[:-1], edge2[:-1] + len(x1)])[order]
                return gather(np.concatenate([x1, x2]), starts, counts), edges(counts)

            self.runs.append((keys[order], *both(w1, v1, w2, v2), *both(f1, e1, f2, e2)))


def edges(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in shown else chr(spare))
        spare += b not in shown
    return out


class PairMerges:
    """A merge table with word-end symbols, applied to many words at once.

    Every step merges the leftmost pair of least rank of each word that has one, until none has.
    """

    #: Longer words go to the library one by one: steps grow with a word's length.
    LONG = 256

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        #: Ids of the literal strings that the tokenizer takes out of a text before all else.
        self.added = {t["content"]: t["id"] for t in whole.get("added_tokens") or []}
        self.plain_added = not any(t[f] for t in whole.get("added_tokens") or [] for f in ("single_word", "lstrip", "rstrip", "normalized"))
        self.path, vocab, end = path, model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.uint16)
        self.final = np.array([vocab[c + end] for c in letters], np.uint16)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint32)
        right = np.array([vocab[b] for _, b in pairs], np.uint32)
        made = np.array([vocab[a + b] for a, b in pairs], np.uint16)
        self.bits = 19
        self.keys = np.full(1 << self.bits, 0xFFFFFFFF, np.uint32)
        self.rank = np.full(1 << self.bits, 0x7FFFFFFF, np.int32)
        self.made = made
        seen = (left << np.uint32(16)) | right
        for rank, (key, slot) in enumerate(zip(seen.tolist(), self._slot(seen).tolist(), strict=True)):
            while self.keys[slot] != 0xFFFFFFFF and self.keys[slot] != key:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            if self.keys[slot] == 0xFFFFFFFF:
                self.keys[slot], self.rank[slot] = key, rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint32(2654435769)) >> np.uint32(32 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint32) << np.uint32(16)) | right
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.rank[slot], 0x7FFFFFFF).astype(np.int32)
        open_ = np.flatnonzero((found != key) & (found != 0xFFFFFFFF))
        slot = slot[open_]
        while len(open_):
            slot = (slot + np.uint32(1)) & np.uint32((1 << self.bits) - 1)
            found = self.keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.rank[slot[hit]]
            on = ~hit & (found != 0xFFFFFFFF)
            open_, slot = open_[on], slot[on]
        return out

    def at_added(self, text: str) -> tuple[list[str], list[int]]:
        """The text cut at its added tokens (leftmost, then longest), and their ids."""
        if not self.plain_added:
            raise ValueError(f"{self.path}: added tokens that strip blanks, need whole words or are normalised")
        if not self.added:
            return [text], []
        parts = re.split("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")", text)
        return parts[::2], [self.added[t] for t in parts[1::2]]

    @property
    @lru_cache(1)  # noqa: B019
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words raw[start:end], end to end, and how many each has."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # word numbers, ids end to end
        size = ends - starts
        for w in np.flatnonzero(size > self.LONG):
            ids = self.library.encode(raw[starts[w] : ends[w]].tobytes().decode(), add_special_tokens=False).ids
            counts[w] = len(ids)
            parts.append((np.array([w]), np.array(ids, np.uint16)))
        short = np.flatnonzero((size <= self.LONG) & (size > 0))
        for lo in range(0, len(short), 1 << 16):
            self._merge(raw, starts, size, short[lo : lo + (1 << 16)], counts, parts)
        out = np.empty(int(counts.sum()), np.uint16)
        to = np.cumsum(counts) - counts
        for words, ids in parts:
            c = counts[words]
            out[np.repeat(to[words] - (np.cumsum(c) - c), c) + np.arange(len(ids))] = ids
        return out, counts

    def _merge(self, raw, starts, size, words, counts, parts) -> None:
        none = np.int32(0x7FFFFFFF)
        length = size[words]
        sym = self.inner[gather(raw, starts[words], length)]
        head = np.cumsum(length) - length
        last = head + length - 1
        sym[last] = self.final[raw[starts[words] + length - 1]]
        rank = np.full(len(sym), none, np.int32)
        if len(sym) > 1:
            rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[last] = none
        while len(words):
            best = np.minimum.reduceat((rank.astype(np.int64) << 32) | np.arange(len(rank)), head)
            done = (best >> 32) == none
            if done.any():
                c = length[done]
                counts[words[done]] = c
                parts.append((words[done], gather(sym, head[done], c)))
                go = ~done
                keep = np.repeat(go, length)
                shift = np.cumsum(~keep)
                best = best[go]
                best -= shift[best & 0xFFFFFFFF]
                words, length, sym, rank = words[go], length[go], sym[keep], rank[keep]
                head = np.cumsum(length) - length
                if not len(words):
                    break
            at = best & 0xFFFFFFFF
            sym[at] = self.made[best >> 32]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, rank = sym[keep], rank[keep]
            at = at - np.arange(len(at))  # one symbol went from every word before
            length = length - 1
            head = np.cumsum(length) - length
            tail = head + length - 1
            rank[at] = none
            more = np.flatnonzero(at < tail)
            rank[at[more]] = self.ranks(sym[at[more]], sym[at[more] + 1])
            more = np.flatnonzero(at > head)
            rank[at[more] - 1] = self.ranks(sym[at[more] - 1], sym[at[more]])


@lru_cache(1)
def pair_merges(path: str) -> PairMerges:
    return PairMerges(path)


def utf8_words(texts: list[str], cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts, and the byte starts and ends of code point spans that ascend."""
    raw = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) == len(cp):
        return raw, starts, ends
    width = np.ones(len(cp) + 1, np.int64)
    width[0] = 0
    width[1:] += (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
    at = np.cumsum(width)
    return raw, at[starts], at[ends]


def spans(texts: list[str], split) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts: distinct keys; UTF-8 bytes, with the start and end of one word for each
    key; every word's key number; and how many words each text has."""
    cp, offsets = tn.points(texts)
    starts, ends = split(cp, offsets)
    per_row = np.diff(np.searchsorted(starts, offsets))
    raw, b_starts, b_ends = utf8_words(texts, cp, starts, ends)
    keys, pick, code = tn.distinct_spans(raw, b_starts, b_ends)
    return keys, raw, b_starts[pick], b_ends[pick], code, per_row


def expand(flat: np.ndarray, counts: np.ndarray, code: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of every word by its key number, end to end, and how many values each text has."""
    each = counts[code]
    total = np.concatenate([[0], np.cumsum(each)])
    row_edge = np.concatenate([[0], np.cumsum(per_row)])
    return gather(flat, (np.cumsum(counts) - counts)[code], each), np.diff(total[row_edge])


def span_ids(texts: list[str], split, cache: IdCache, encode, extra: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and how many each text has. With extra, id 0 ends every text."""
    keys, raw, starts, ends, code, per_row = spans(texts, split)
    flat, counts = cache.ids(keys, raw, starts, ends, lambda new: encode(raw, starts[new], ends[new]))
    if extra:  # one more word, of the one id 0
        flat, counts = np.append(flat, 0).astype(flat.dtype), np.append(counts, 1)
        code = np.insert(code, np.cumsum(per_row), len(keys))
        per_row = per_row + 1
    return expand(flat, counts, code, per_row)
