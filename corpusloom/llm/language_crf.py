"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnum as tn
from .common import modest_batches
from .pieces import gather

U64 = np.uint64
UNDETERMINED = "und"


@dataclass(frozen=True)
class CRFParams:
    """``docs_per_language`` rows and ``sample_bytes`` of text bound the labelled rows of a language that
    are fitted; all else is the model's shape. Every language is a label.

    Training sequences are ``length`` words long and switch language after ``run`` words on average,
    so that the transitions are learned on mixed text. Features hash into ``table`` rows.
    """

    docs_per_language: int = 150
    sample_bytes: int = 8 << 20
    length: int = 64
    run: int = 20
    table: int = 1 << 16
    steps: int = 30
    rate: float = 0.3
    decay: float = 1e-4
    lexicon: int = 20_000
    seed: int = 11


def letter_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points, starts and ends of the runs of letters, and how many each text has."""
    cp, offsets = tn.points([(t or "").lower() for t in texts])
    if not len(cp):
        return cp, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    letter = tn.classes()[cp] == tn.LETTER
    edge = offsets[(offsets > 0) & (offsets < len(cp))]
    begin, final = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1]
    begin[edge] = letter[edge]
    final[:-1] &= ~letter[1:]
    final[edge - 1] = letter[edge - 1]
    starts = np.flatnonzero(begin)
    return cp, starts, np.flatnonzero(final) + 1, np.diff(np.searchsorted(starts, offsets))


def features(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, end to end, and how many each has: all pairs and triples of the word
    with its edges marked, and its first and last one to four letters."""
    size = ends - starts
    wide = size + 2
    at = np.cumsum(wide) - wide
    padded = np.empty(int(wide.sum()) + 2, U64)
    padded[:] = 1
    padded[at] = 2
    inner = np.repeat(at + 1 - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    padded[inner] = gather(cp, starts, size).astype(U64) + U64(3)
    with np.errstate(over="ignore"):
        two = tn.mix(padded[:-1] * U64(0x9FB21C651E98DF25) + padded[1:])
        three = tn.mix(two[:-1] * U64(0x9FB21C651E98DF25) + padded[2:])
        affix = []
        for k in range(1, 5):
            head = tail = np.full(len(at), k, U64)
            fits = size >= k
            for j in range(k):
                head = tn.mix(head * U64(0x9FB21C651E98DF25) + padded[np.where(fits, at + 1 + j, at)])
                tail = tn.mix(tail * U64(0xD1342543DE82EF95) + padded[np.where(fits, at + size - j, at)])
            affix += [np.where(fits, head, U64(0)), np.where(fits, tail, U64(0))]
    n_two, n_three = wide - 1, wide - 2
    total = n_two + n_three + len(affix)
    out = np.empty(int(total.sum()), U64)
    to = np.cumsum(total) - total
    for source, n, shift in ((two, n_two, 0), (three, n_three, n_two)):
        here = np.repeat(to + shift - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out[here] = gather(source, at, n)
    for j, values in enumerate(affix):
        out[to + n_two + n_three + j] = values
    return (out % U64(table)).astype(np.int64), total


def chain_posteriors(emit: np.ndarray, trans: np.ndarray, counts: np.ndarray, block: int = 32) -> np.ndarray:
    """Forward-backward marginals of chains that lie end to end: emit is words x labels (log scores).

    Chains are cut into blocks. Blocks' transfer products, all at once, give the messages at block
    edges; then all blocks run forward and backward together. This is exact.
    """
    n, labels = emit.shape
    if not n:
        return emit.copy()
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    counts = counts[counts > 0]
    n_blocks = -(-counts // block)
    first = np.cumsum(n_blocks) - n_blocks
    total = int(n_blocks.sum())
    chain = np.repeat(np.arange(len(counts)), n_blocks)
    number = np.arange(total) - first[chain]
    start = (np.cumsum(counts) - counts)[chain] + number * block
    size = np.minimum(block, counts[chain] - number * block)
    grid = np.minimum(start[:, None] + np.arange(block), n - 1)
    here = np.arange(block)[None, :] < size[:, None]

    def unit(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=-1, keepdims=True)

    # Transfer of each block: row = label before it, column = label of its last word.
    move = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    opening = number == 0  # a chain's first word has no transition before it
    for t in range(block):
        nxt = move @ a if t else np.where(opening[:, None, None], move, move @ a)
        nxt = nxt * e[grid[:, t]][:, None, :]
        nxt /= nxt.sum(axis=(1, 2), keepdims=True)
        move = np.where(here[:, t][:, None, None], nxt, move)
    before, after = np.empty((total, labels)), np.empty((total, labels))
    order = np.argsort(-n_blocks, kind="stable")
    fewest = n_blocks[order][::-1]
    state = np.full((len(counts), labels), 1.0 / labels)
    for k in range(int(n_blocks.max())):
        live = order[: len(order) - int(np.searchsorted(fewest, k, "right"))]
        b = first[live] + k
        before[b] = state[live]
        state[live] = unit((state[live][:, None, :] @ move[b])[:, 0, :])
    state = np.ones((len(counts), labels))
    for k in range(int(n_blocks.max()) - 1, -1, -1):
        live = order[: len(order) - int(np.searchsorted(fewest, k, "right"))]
        b = first[live] + k
        after[b] = state[live]
        state[live] = unit((move[b] @ state[live][:, :, None])[:, :, 0])
    out = np.empty((n, labels))
    forward = np.empty((block, total, labels))
    for t in range(block):
        nxt = before @ a if t else np.where(opening[:, None], before, before @ a)
        before = np.where(here[:, t][:, None], unit(nxt * e[grid[:, t]]), before)
        forward[t] = before
    for t in range(block - 1, -1, -1):
        on = here[:, t]
        out[grid[on, t]] = unit(forward[t][on] * after[on])
        after = np.where(on[:, None], unit((after * e[grid[:, t]]) @ a.T), after)
    return out


#: Labels up to which texts are taken by 1 MB, in blocks of 32 words; more labels take less at once.
FEW_LABELS = 64
#: Numbers that fitting holds at once in each of its tables by word and label.
FIT_CELLS = 1 << 23


class LanguageCRF:
    """Weights of hashed features and of lexicon words for each language, and transitions."""

    def __init__(self, labels: list[str], params: CRFParams):
        self.labels, self.params = labels, params
        self.weights = np.zeros((params.table, len(labels)), np.float32)
        self.words = np.empty(0, U64)
        self.word_weights = np.zeros((1, len(labels)), np.float32)
        self.trans = np.zeros((len(labels), len(labels)))

    def emissions(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the distinct words, and every word's number among them."""
        keys, pick, code = tn.distinct_spans(cp, starts, ends)
        index, counts = features(cp, starts[pick], ends[pick], self.params.table)
        scores = np.add.reduceat(self.weights[index], np.cumsum(counts) - counts).astype(np.float64)
        return scores + self.word_weights[self.lexicon_row(keys)], code

    def lexicon_row(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, at + 1, 0)

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of every word, words per text, and the words' starts and ends within all texts."""
        cp, starts, ends, counts = letter_words(texts)
        if not len(starts):
            return np.empty((0, len(self.labels))), counts, starts, ends
        scores, code = self.emissions(cp, starts, ends)
        return chain_posteriors(scores[code], self.trans, counts, int(32 * self.crowding())), counts, starts, ends

    def crowding(self) -> float:
        """How much more room a block's transfers need than those of FEW_LABELS labels."""
        return max(1.0, (len(self.labels) / FEW_LABELS) ** 2)

    def fit(self, texts: list[str], langs: list[str]) -> LanguageCRF:
        """Maximise the conditional likelihood of mixed sequences spliced from the texts' words."""
        p, rng = self.params, np.random.default_rng(self.params.seed)
        cp, starts, ends, counts = letter_words(texts)
        place = {x: i for i, x in enumerate(self.labels)}
        label = np.repeat([place[x] for x in langs], counts)
        keys, pick, code = tn.distinct_spans(cp, starts, ends)
        index, per_word = features(cp, starts[pick], ends[pick], p.table)
        often = np.bincount(code, minlength=len(keys))
        known = np.argsort(-often, kind="stable")[: p.lexicon]
        known = known[often[known] > 1]
        self.words = np.sort(keys[known])
        self.word_weights = np.zeros((len(self.words) + 1, len(self.labels)), np.float32)
        row = self.lexicon_row(keys)
        # Splice: runs of words of one text after runs of another, in a random order.
        cut = np.flatnonzero((rng.random(len(code)) < 1 / p.run) | np.concatenate([[True], np.diff(np.repeat(np.arange(len(counts)), counts)) > 0]))
        length = np.diff(np.append(cut, len(code)))
        shuffled = rng.permutation(len(cut))
        order = gather(np.arange(len(code)), cut[shuffled], length[shuffled])
        n_seq = max(1, len(order) // p.length)
        order = np.resize(order, n_seq * p.length)
        code, label = code[order].reshape(n_seq, -1), label[order].reshape(n_seq, -1)
        edge = np.cumsum(per_word) - per_word
        owner = np.repeat(np.arange(len(keys)), per_word)
        n_labels = len(self.labels)
        used, slot = np.unique(index, return_inverse=True)
        w = np.zeros((len(used), n_labels))
        v = np.zeros_like(self.word_weights, dtype=np.float64)
        trans = np.zeros((n_labels, n_labels))
        squares = [np.full_like(x, 1e-6) for x in (w, v, trans)]
        gold = np.zeros((len(keys), n_labels))
        np.add.at(gold, (code.ravel(), label.ravel()), 1.0)
        gold_trans = np.zeros_like(trans)
        np.add.at(gold_trans, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1.0)
        scale = 1.0 / code.size
        word_step = max(1, FIT_CELLS // (n_labels * int(per_word.max(initial=1))))
        seq_step = max(1, FIT_CELLS // (n_labels * max(n_labels, p.length)))
        for _ in range(p.steps):
            emit = v[row]
            for a in range(0, len(keys), word_step):
                b = min(len(keys), a + word_step)
                end = edge[b] if b < len(keys) else len(slot)
                emit[a:b] += np.add.reduceat(w[slot[edge[a] : end]], edge[a:b] - edge[a])
            miss, expected_trans = np.zeros_like(gold), np.zeros_like(trans)
            for a in range(0, n_seq, seq_step):
                some = code[a : a + seq_step]
                expected, moves = self._expectations(emit[some], trans)
                for k in range(n_labels):
                    miss[:, k] += np.bincount(some.ravel(), expected[:, :, k].ravel(), len(keys))
                expected_trans += moves
            miss = (gold - miss) * scale
            grad_w = np.stack([np.bincount(slot, miss[owner, k], len(used)) for k in range(n_labels)], axis=1) - p.decay * scale * w
            grad_v = np.stack([np.bincount(row, miss[:, k], len(v)) for k in range(n_labels)], axis=1)
            grad_v[0] = 0
            for x, g, s in zip((w, v, trans), (grad_w, grad_v, (gold_trans - expected_trans) * scale), squares, strict=True):
                s += (g / scale) ** 2
                x += p.rate * (g / scale) / np.sqrt(s)
        self.weights[used] = w
        self.word_weights, self.trans = v.astype(np.float32), trans
        return self

    @staticmethod
    def _expectations(emit: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels and transitions of equally long sequences."""
        n, length, labels = emit.shape
        e = np.exp(emit - emit.max(axis=2, keepdims=True))
        a = np.exp(trans - trans.max())
        forward, backward = np.empty_like(e), np.empty_like(e)
        x = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        forward[:, 0] = x
        for t in range(1, length):
            x = (x @ a) * e[:, t]
            x /= x.sum(axis=1, keepdims=True)
            forward[:, t] = x
        x = np.ones((n, labels))
        backward[:, -1] = x
        for t in range(length - 2, -1, -1):
            x = (x * e[:, t + 1]) @ a.T
            x /= x.sum(axis=1, keepdims=True)
            backward[:, t] = x
        both = forward * backward
        both /= both.sum(axis=2, keepdims=True)
        move = np.zeros((labels, labels))
        for t in range(length - 1):
            pair = forward[:, t][:, :, None] * a * (e[:, t + 1] * backward[:, t + 1])[:, None, :]
            move += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return both, move


def train(labelled: DataFrame, params: CRFParams | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageCRF:
    """Fit on at most ``docs_per_language`` labelled rows of each language, those of least hash of id and
    text, as far as their texts fit in ``sample_bytes``; texts are fitted whole.

    Every language of a row with text and language is learned, other rows are left out. Rows that share
    an id are rows of their own. Of a common language only rows of small hash are looked at, some eight
    times as many as are wanted. The driver's memory grows with languages, and with these times the
    distinct words of the sample.
    """
    p = params or CRFParams()
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"))
    held = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not held:
        return LanguageCRF([], p)
    wanted = 8 * p.docs_per_language
    shares = [F.lit(x) for k, n in held.items() if n > wanted for x in (k, wanted / n)]
    if shares:
        rows = rows.filter(F.pmod("h", F.lit(1 << 32)) < F.coalesce(F.create_map(*shares)[F.col("lang")], F.lit(1.0)) * F.lit(float(1 << 32)))
    order = Window.partitionBy("lang").orderBy("h", "text")
    rows = rows.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= p.docs_per_language)
    total = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("turn"))
    sample = rows.withColumn("total", total).filter((F.col("turn") == 1) | (F.col("total") <= p.sample_bytes)).select("lang", "text", "turn").collect()
    sample.sort(key=lambda r: (r["lang"], r["turn"]))
    return LanguageCRF(sorted(held), p).fit([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: LanguageCRF, id_col: str = "doc_id", text_col: str = "text", with_words: bool = False) -> DataFrame:
    """Label every word of every whole text, and each text by its words: ``id_col, lang_pred, score, n_words``.

    ``lang_pred`` has the largest sum of word marginals (the first by name of equals); ``score`` is
    its mean marginal, 0 to 1. With ``with_words``, ``words`` lists runs of words of one label as
    (first, last, lang). There is no shuffle; only text is read.

    Texts that are null, empty or without a letter are ``und`` with score 0, as is every text under a
    model of no language. Very long texts are one chain. Repeated rows and null ids are returned as
    they come; an empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    modest_batches(docs)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType())])
    run_type = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())])
    if with_words:
        schema = schema.add("words", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("lang", T.StringType())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.labels, UNDETERMINED], object)
        for batch in batches:
            _, offsets = tn.utf8(batch.column(1))
            for lo, hi in tn.row_ranges(offsets, int((1 << 20) / model.crowding())):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                if not model.labels:
                    texts = [None] * len(texts)
                marginal, counts, _, _ = model.posteriors(texts)
                edge = np.concatenate([[0], np.cumsum(counts)])
                total = np.concatenate([np.zeros((1, marginal.shape[1])), np.cumsum(marginal, axis=0)])
                sums = np.round(total[edge[1:]] - total[edge[:-1]], 9)
                best = np.where(counts > 0, sums.argmax(axis=1) if sums.shape[1] else 0, -1)
                score = np.where(counts > 0, sums.max(axis=1, initial=0) / np.maximum(counts, 1), 0.0)
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(counts.astype(np.int64))]
                if with_words:
                    each = marginal.argmax(axis=1) if len(marginal) else np.empty(0, np.int64)
                    cols.append(pa.array([_runs(each[a:b], model.labels) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.list_(run_type)))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        tn.trim()

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _runs(labels: np.ndarray, names: list[str]) -> list[dict]:
    if not len(labels):
        return []
    first = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]]))
    last = np.append(first[1:], len(labels)) - 1
    return [{"first": int(a), "last": int(b), "lang": names[labels[a]]} for a, b in zip(first, last, strict=True)]
