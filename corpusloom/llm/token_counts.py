"""Greedy longest-match token counts by a linear-time automaton."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textnum as tn
from .common import modest_batches

ROOT = 0


class LongestMatch:
    """A vocabulary trie with failure links and the counts of tokens popped along them.

    Scanning a word takes each byte once: where a node has no child for it, the node's popped count
    is added and its failure link followed. No piece is ever built. Every byte is a token of its own
    (added where the vocabulary lacks it), so a match never fails for good.
    """

    def __init__(self, vocabulary: list[bytes]):
        tokens = {v for v in vocabulary if v} | {bytes([b]) for b in range(256)}
        children: list[dict[int, int]] = [{}]
        final: list[bool] = [False]
        for token in sorted(tokens):
            at = ROOT
            for b in token:
                to = children[at].get(b)
                if to is None:
                    to = children[at][b] = len(children)
                    children.append({})
                    final.append(False)
                at = to
            final[at] = True
        fail, popped = [ROOT] * len(children), [0] * len(children)
        queue: deque[int] = deque([ROOT])
        while queue:
            u = queue.popleft()
            for b, v in children[u].items():
                if final[v]:
                    fail[v], popped[v] = ROOT, 1
                else:
                    z, n = fail[u], popped[u]
                    while b not in children[z]:
                        n += popped[z]
                        z = fail[z]
                    fail[v], popped[v] = children[z][b], n
                queue.append(v)
        inner = [i for i, c in enumerate(children) if c]
        self.row = np.zeros(len(children), np.int32)  # row 0: no children
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.child = np.full((len(inner) + 1, 256), -1, np.int32)
        for k, i in enumerate(inner, 1):
            self.child[k, list(children[i])] = list(children[i].values())
        self.fail, self.popped = np.array(fail, np.int32), np.array(popped, np.int64)

    def counts(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of blank + word, for every word of raw; all words advance together, byte by byte."""
        order = np.argsort(starts - ends, kind="stable")  # longest first
        begin, size = starts[order], (ends - starts)[order]
        state = np.full(len(order), self.child[self.row[ROOT], 0x20], np.int32)
        total = np.zeros(len(order), np.int64)
        shortest = size[::-1]
        for t in range(int(size[0]) if len(order) else 0):
            live = len(order) - int(np.searchsorted(shortest, t, "right"))  # words of more than t bytes
            byte = raw[begin[:live] + t]
            to = self.child[self.row[state[:live]], byte]
            lost = np.flatnonzero(to < 0)
            while len(lost):
                total[lost] += self.popped[state[lost]]
                state[lost] = self.fail[state[lost]]
                to[lost] = self.child[self.row[state[lost]], byte[lost]]
                lost = lost[to[lost] < 0]
            state[:live] = to
        while len(left := np.flatnonzero(state != ROOT)):
            total[left] += self.popped[state[left]]
            state[left] = self.fail[state[left]]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


@lru_cache(2)
def from_ranks(path: str) -> LongestMatch:
    """The automaton of a rank file (base64 token, blank, rank on each line)."""
    with open(path, "rb") as lines:
        return LongestMatch([base64.b64decode(x.split()[0]) for x in lines if x.strip()])


def count_batch(machine: LongestMatch, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of every row."""
    raw, offsets = tn.utf8(column)
    n_words, n_tokens = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    for lo, hi in tn.row_ranges(offsets):
        base = offsets[lo]
        part, off = raw[base : offsets[hi]], offsets[lo : hi + 1] - base
        starts, ends, per_row = tn.words(part, off)
        if not len(starts):
            continue
        _, pick, back = tn.distinct_spans(part, starts, ends)
        each = machine.counts(part, starts[pick], ends[pick])[back]
        total = np.concatenate([[0], np.cumsum(each)])
        edge = np.concatenate([[0], np.cumsum(per_row)])
        n_words[lo:hi], n_tokens[lo:hi] = per_row, np.diff(total[edge])
    return n_words, n_tokens


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the greedy longest-match pieces of every text: ``id_col, n_words, n_tokens``.

    A text's words are its runs of ``[^\\x20\\x09-\\x0D]``. Each word, with a blank before it, is cut
    from the left into the longest tokens of the vocabulary; a byte that no token covers is a token.
    Within a batch every distinct word is scanned once. The work needs no shuffle.

    Null and empty texts have 0 words and 0 tokens; a very long text, or word, is scanned whole in
    time linear in its length. Repeated rows and null ids are returned as they come; an empty table
    gives an empty result. Other columns are ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = from_ranks(vocabulary_path)
        for batch in batches:
            n_words, n_tokens = count_batch(machine, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_tokens)], names=[id_col, "n_words", "n_tokens"])

    modest_batches(docs)
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
