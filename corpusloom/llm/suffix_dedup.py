"""Removal of repeated passages: every long enough string that a smaller document also holds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnum as tn
from .common import checkpoint, modest_batches, release, shrink
from .pieces import edges, gather
from .suffix_order import PERIOD, suffix_order, words_at

U64 = np.uint64


@dataclass(frozen=True)
class Repeats:
    """``length``: bytes of a repeat. ``gram``: bytes of an anchor. ``crowd``: segments that are sorted
    together; an anchor with more distinct ones has them dealt out window by window. ``bucket_bytes``:
    what a task gathers. ``block``: sightings of anchors that are summed up before they are dealt out."""

    length: int = 50
    gram: int = 16
    crowd: int = 16_384
    bucket_bytes: int = 8 << 20
    block: int = 500_000


#: A chunk's positions fit in 16 bits, which leave 48 for an anchor's hash.
CHUNK = 60_000
_MULT = U64(0x9FB21C651E98DF25)


def grams(part: np.ndarray, p: Repeats) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every place on; gram is a power of two."""
    g, size = part.astype(U64) + U64(1), 1
    with np.errstate(over="ignore"):
        while size < p.gram:
            g = tn.mix(g[:-size] * _MULT + g[size:])
            size *= 2
    return g


def digests(g: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of spans of at least ``gram`` bytes, from the hashes of the grams that cover them."""
    size = ends - starts
    c1 = tn.mix(size.astype(U64) ^ g[starts])
    odd = _MULT
    with np.errstate(over="ignore"):
        c2 = g[starts] * odd
        live, at = np.arange(len(starts)), p.gram
        while len(live := live[size[live] > at]):
            odd = odd * _MULT
            own = g[np.minimum(starts[live] + at, ends[live] - p.gram)]
            c1[live] = tn.mix(c1[live] * _MULT ^ own)
            c2[live] += own * odd
            at += p.gram
    return c1, (c2 >> U64(32)).astype(np.uint32)


def anchor_runs(part: np.ndarray, edges: np.ndarray, p: Repeats, g: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows (strings of ``length`` bytes within a row) that share an anchor.

    A window's anchor is its leftmost ``gram`` bytes of least hash, so equal windows have equal anchors
    at equal places. Returns hash (48 bits), row, first and last window start, anchor start.
    """
    n, span = len(part), p.length - p.gram + 1
    if n < p.length:
        return (np.empty(0, U64), *(np.empty(0, np.int64) for _ in range(4)))
    g = grams(part, p) if g is None else g
    least = (g & ~U64(0xFFFF)) | np.arange(len(g), dtype=U64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(g) - span + 1], least[span - size :][: len(g) - span + 1])
    valid = np.ones(n + 1, np.int8)
    some = edges[1:] > edges[:-1]  # an empty row's start is the next row's
    begin, close = edges[:-1][some], edges[1:][some]
    for d in range(1, p.length):
        valid[np.maximum(close - d, begin)] = 0
    valid = valid[: len(least)].astype(bool)
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    stop = valid.copy()
    stop[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
    s0, s1 = np.flatnonzero(new), np.flatnonzero(stop)
    key = least[s0]
    return key >> U64(16), np.searchsorted(edges, s0, "right") - 1, s0, s1, (key & U64(0xFFFF)).astype(np.int64)


def chunks(raw: np.ndarray, offsets: np.ndarray, p: Repeats) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Short rows together, and long rows in pieces that overlap by a window less one byte:
    first row, bytes, row edges, and the piece's place in its row."""
    for lo, hi in tn.row_ranges(offsets, CHUNK):
        base, end = offsets[lo], offsets[hi]
        if end - base <= CHUNK:
            yield lo, raw[base:end], offsets[lo : hi + 1] - base, 0
            continue
        step = CHUNK - p.length + 1
        for a in range(0, int(end - base - p.length + 1), step):
            part = raw[base + a : min(end, base + a + CHUNK)]
            yield lo, part, np.array([0, len(part)]), a


# ---- Packed rows: arrays end to end in one binary value ------------------------------------------

#: What a row holds: sightings of anchors, spans that go, or segments of text.
SEEN, GONE, TEXT = 0, 1, 2
PACKED = "bucket int, kind int, n int, m int, data binary"
#: Packed rows leave a worker in batches of about so many bytes.
SENT_BYTES = 2 << 20
_SEEN = ("<u8", "<u8", "<u4", "<u4", "<u2", "<u2")  # anchor and document's number; digest (two); start; windows; lead
_SPAN = ("<i8", "<i8", "<u4", "<u4")  # id, uid, start, end
_TEXT = ("<u8", "<i8", "<i8", "<u4", "<u2", "<u2")  # anchor, id, uid, start, windows, lead
_LIST = ("<i8", "<i8", "<u8", "<u4", "<u2", "<u2", "<u1")  # id, uid, anchor, start, windows, lead, whether it is crowded


def _pack(kinds: tuple[str, ...], columns: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c, k).tobytes() for k, c in zip(kinds, columns, strict=True))


def _unpack(kinds: tuple[str, ...], data, n: int, at: int = 0) -> tuple[list[np.ndarray], int]:
    out = []
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += out[-1].nbytes
    return out, at


def _together(parts: list[list[np.ndarray]], kinds: tuple[str, ...]) -> list[np.ndarray]:
    return [np.concatenate([p[c] for p in parts]) if parts else np.empty(0, k) for c, k in enumerate(kinds)]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["bucket", "kind", "n", "m", "data"])


def _buckets(anchor: np.ndarray, n: int) -> np.ndarray:
    """The bucket of anchors. They are least hashes, so mostly small: another scramble spreads them evenly."""
    return (((tn.mix(anchor) >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in rows sorted by keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they touch or overlap, by owner (a small number) and start."""
    if not len(owner):
        return owner, start, end
    a, b = (owner.astype(np.int64) << 33) + start, (owner.astype(np.int64) << 33) + end
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.concatenate([[True], a[1:] > b[:-1]])
    last = np.append(first[1:], True)
    return a[first] >> 33, a[first] & ((1 << 33) - 1), b[last] & ((1 << 33) - 1)


def _numbered(ids: np.ndarray, uids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every row's number among the distinct documents (id, uid), and these."""
    order = np.lexsort([uids, ids])
    new = _groups(ids[order], uids[order]) if len(ids) else np.zeros(0, bool)
    number = np.empty(len(ids), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, ids[order][new], uids[order][new]


# ---- Sightings of anchors ------------------------------------------------------------------------


def _sightings(docs: DataFrame, p: Repeats, n_buckets: int) -> DataFrame:
    """Blocks of text, summed up for each bucket of anchors.

    A run of windows with one anchor is a segment of text, known by its digest. Of equal segments
    of a block only those of the least document go out; the others are spans that go.
    """

    def block(ids: np.ndarray, uids: np.ndarray, found: list[list[np.ndarray]], turn: int) -> Iterator[pa.RecordBatch]:
        columns = []
        for _ in range(7):  # column by column, each let go as it is joined
            columns.append(np.concatenate([f.pop(0) for f in found]))
        h, c1, c2, doc, start, windows, lead = columns
        order = np.argsort(c1, kind="stable")
        new = _groups(c1[order], c2[order], h[order])
        heads = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(ids[doc[order]], heads), np.diff(np.append(heads, len(order))))
        copied = np.empty(len(order), bool)
        copied[order] = ids[doc[order]] > least
        rows = []
        if copied.any():
            own, a, b = _merged(doc[copied], start[copied], start[copied] + windows[copied] - 1 + p.length)
            rows.append((turn % n_buckets, GONE, len(own), 0, _pack(_SPAN, [ids[own], uids[own], a, b])))
        rest = np.flatnonzero(~copied)
        bucket = _buckets(h[rest], n_buckets)
        by_bucket = np.lexsort([h[rest], bucket])
        rest, bucket = rest[by_bucket], bucket[by_bucket]
        del h, c1, c2, doc, start, windows, lead, order, by_bucket
        for c in range(7):
            columns[c] = columns[c][rest]
        h, c1, c2, doc, start, windows, lead = columns
        cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
        held = sum(len(r[-1]) for r in rows)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            i = slice(cuts[k], cuts[k + 1])
            used, number = np.unique(doc[i], return_inverse=True)
            table = _pack(("<i8", "<i8"), [ids[used], uids[used]])
            rows.append((k, SEEN, len(number), len(used), table + _pack(_SEEN, [(h[i] << U64(16)) | number.astype(U64), c1[i], c2[i], start[i], windows[i], lead[i]])))
            held += len(rows[-1][-1])
            if held > SENT_BYTES:
                yield _packed(rows)
                rows, held = [], 0
        if rows:
            yield _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, known, turn = [], 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            return block(np.concatenate([k[0] for k in known]), np.concatenate([k[1] for k in known]), found, turn)

        for batch in batches:
            ids, uids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            raw, offsets = tn.utf8(batch.column(2))
            for lo in range(0, len(ids), 1 << 12):
                hi = min(len(ids), lo + (1 << 12))
                if held and sum(len(k[0]) for k in known) + hi - lo > 1 << 16:  # numbers have 16 bits
                    yield from flush()
                    found, held, known, turn = [], 0, [], turn + 1
                base = sum(len(k[0]) for k in known)
                known.append((ids[lo:hi], uids[lo:hi]))
                for row, part, edge, place in chunks(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], p):
                    g = grams(part, p)
                    h, r, s0, s1, at = anchor_runs(part, edge, p, g)
                    if not len(h):
                        continue
                    found.append([h, *digests(g, s0, s1 + p.length, p), (r + row + base).astype(np.int32), s0 - edge[r] + place, (s1 - s0 + 1).astype(np.uint16), (at - s0).astype(np.uint16)])
                    held += len(h)
                    if held > p.block:
                        yield from flush()
                        found, held, turn = [], 0, turn + 1
            if not held:
                known = []
        if held:
            yield from flush()
        tn.trim()

    return docs.select("id", "uid", "text").mapInArrow(run, PACKED)


def _dealt(kind: int, kinds: tuple[str, ...], columns: list[np.ndarray], n_docs: int) -> list[tuple]:
    """Rows that begin with a document's id and uid, packed for each bucket of documents."""
    with np.errstate(over="ignore"):
        bucket = (tn.mix(columns[0].view(U64) ^ tn.mix(columns[1].view(U64))) % U64(n_docs)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    columns = [c[order] for c in columns]
    cuts = np.searchsorted(bucket[order], np.arange(n_docs + 1))
    return [(b, kind, int(cuts[b + 1] - cuts[b]), 0, _pack(kinds, [c[cuts[b] : cuts[b + 1]] for c in columns])) for b in np.flatnonzero(np.diff(cuts)).tolist()]


def _spans(spans: list[np.ndarray], n_docs: int) -> list[tuple]:
    """Spans that go, joined, and packed for each bucket of documents."""
    number, ids, uids = _numbered(spans[0], spans[1])
    own, a, b = _merged(number, spans[2], spans[3])
    return _dealt(GONE, _SPAN, [ids[own], uids[own], a, b], n_docs)


def _by_document(packed: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``id, uid, list``: the packed rows of each document together, without its id and uid."""

    def run(rows: pa.Table) -> pa.Table:
        columns = _together([_unpack(kinds, data.as_buffer(), n)[0] for n, data in zip(rows["n"].to_pylist(), rows["data"], strict=True)], kinds)
        number, ids, uids = _numbered(columns[0], columns[1])
        order = np.argsort(number, kind="stable")
        rest = [c[order] for c in columns[2:]]
        cuts = np.searchsorted(number[order], np.arange(len(ids) + 1)).tolist()
        lists = [_pack(kinds[2:], [c[a:b] for c in rest]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        tn.trim()
        return pa.table({"id": ids, "uid": uids, "list": pa.array(lists, pa.binary())})

    return packed.groupBy("bucket").applyInArrow(run, "id long, uid long, list binary")


def _resolved(sightings: DataFrame, p: Repeats, n_docs: int) -> DataFrame:
    """For documents, the spans that go because a smaller document holds the whole segment; and the least
    documents' segments of anchors that several segments share, whose windows are still to be compared."""

    def run(rows: pa.Table) -> pa.Table:
        spans, parts, tables = [], [], []
        for kind, n, m, data in zip(rows["kind"].to_pylist(), rows["n"].to_pylist(), rows["m"].to_pylist(), rows["data"], strict=True):
            data = data.as_buffer()
            if kind == GONE:
                spans.append(_unpack(_SPAN, data, n)[0])
                continue
            (ids, uids), at = _unpack(("<i8", "<i8"), data, m)
            seen, _ = _unpack(_SEEN, data, n, at)
            parts.append(seen)
            tables.append((ids, uids))
        if parts:
            # Only anchors that are seen more than once go on.
            h = np.concatenate([x[0] for x in parts]) >> U64(16)
            order = np.argsort(h, kind="stable")
            heads = np.flatnonzero(_groups(h[order]))
            count = np.diff(np.append(heads, len(h)))
            keep = np.zeros(len(h), bool)
            keep[order] = np.repeat(count > 1, count)
            del order, heads, count
            cuts = np.cumsum([0, *(len(x[0]) for x in parts)])
            ids, uids = (np.concatenate([t[c][(x[0] & U64(0xFFFF)).astype(np.int64)[keep[a:b]]] for t, x, a, b in zip(tables, parts, cuts[:-1], cuts[1:], strict=True)]) for c in (0, 1))
            c1, c2, start, windows, lead = (np.concatenate([x[c] for x in parts])[keep].astype(k) for c, k in ((1, U64), (2, np.uint32), (3, np.int64), (4, np.int64), (5, np.int64)))
            h = h[keep]
            del parts, tables, keep
            order = np.lexsort([ids, c2, c1, h])
            h, c1, c2, ids, uids, start, windows, lead = (x[order] for x in (h, c1, c2, ids, uids, start, windows, lead))
            new = _groups(h, c1, c2)
            heads = np.flatnonzero(new)
            if len(heads):
                copied = ids > np.repeat(ids[heads], np.diff(np.append(heads, len(ids))))
                spans.append([ids[copied], uids[copied], start[copied], (start + windows - 1 + p.length)[copied]])
                # Of each anchor: its distinct segments, and whether their documents differ.
                first = np.flatnonzero(_groups(h[heads]))
                n_kinds = np.diff(np.append(first, len(heads)))
                differ = np.minimum.reduceat(ids[heads], first) < np.maximum.reduceat(ids[heads], first)
                several = np.repeat(np.where(differ, n_kinds, 0), n_kinds)  # by kind
                several = np.repeat(several, np.diff(np.append(heads, len(ids))))
                open_ = ~copied & (several > 1)
                listed = _dealt(TEXT, _LIST, [ids[open_], uids[open_], h[open_], start[open_], windows[open_], lead[open_], several[open_] > p.crowd], n_docs)
            else:
                listed = []
        else:
            listed = []
        out = pa.Table.from_batches([_packed(_spans(_together(spans, _SPAN), n_docs) + listed)])
        tn.trim()
        return out

    return sightings.groupBy("bucket").applyInArrow(run, PACKED)


# ---- Windows of segments that differ -------------------------------------------------------------


def _segments(docs: DataFrame, p: Repeats, n_buckets: int) -> DataFrame:
    """The listed segments' text, dealt to suffix buckets by anchor. Of a crowded anchor every window is
    a segment of its own, dealt by its digest; of equal windows of a block only those of the least
    document go out."""

    def block(found: list[list[np.ndarray]], turn: int) -> pa.RecordBatch:
        h, ids, uids, start, windows, lead, crowded = (np.concatenate([f[c] for f in found]) for c in range(7))
        text = np.concatenate([f[7] for f in found])
        size = windows + p.length - 1
        at = np.cumsum(size) - size
        rows = []
        if crowded.any():
            some = np.flatnonzero(crowded)
            each = np.repeat(some, windows[some])
            k = np.arange(len(each)) - np.repeat(np.cumsum(windows[some]) - windows[some], windows[some])
            place = at[each] + k
            c1, c2 = (tn.span_hashes(text, place, place + p.length, lane) for lane in (0, 1))
            order = np.lexsort([c2, c1])
            heads = np.flatnonzero(_groups(c1[order], c2[order]))
            least = np.repeat(np.minimum.reduceat(ids[each[order]], heads), np.diff(np.append(heads, len(order))))
            copied = np.empty(len(order), bool)
            copied[order] = ids[each[order]] > least
            number, own_ids, own_uids = _numbered(ids[each[copied]], uids[each[copied]])
            own, a, b = _merged(number, start[each[copied]] + k[copied], start[each[copied]] + k[copied] + p.length)
            if len(own):
                rows.append((turn % n_buckets, GONE, len(own), 0, _pack(_SPAN, [own_ids[own], own_uids[own], a, b])))
            each, k, place, c1 = (x[~copied] for x in (each, k, place, c1))
            plain = np.flatnonzero(~crowded)
            h, ids, uids, start, lead, at, windows = (
                np.concatenate([x[plain], y])
                for x, y in ((h, c1 >> U64(16)), (ids, ids[each]), (uids, uids[each]), (start, start[each] + k), (lead, lead[each] - k), (at, place), (windows, np.ones(len(each), np.int64)))
            )
            size = windows + p.length - 1
        bucket = _buckets(h, n_buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            i = order[cuts[b] : cuts[b + 1]]
            rows.append((b, TEXT, len(i), 0, _pack(_TEXT, [h[i], ids[i], uids[i], start[i], windows[i], lead[i]]) + gather(text, at[i], size[i]).tobytes()))
        return _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, turn = [], 0, 0
        for batch in batches:
            ids, uids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            raw, offsets = tn.utf8(batch.column(2))
            for i in range(batch.num_rows):
                data = batch.column(3)[i].as_buffer()
                every, _ = _unpack(_LIST[2:], data, len(data) // 17)
                for lo in range(0, len(every[0]), 1 << 16):
                    h, start, windows, lead, crowded = (x[lo : lo + (1 << 16)] for x in every)
                    start, windows, lead = (x.astype(np.int64) for x in (start, windows, lead))
                    size = windows + p.length - 1
                    found.append([h, np.full(len(h), ids[i]), np.full(len(h), uids[i]), start, windows, lead, crowded.astype(bool), gather(raw, offsets[i] + start, size)])
                    held += int((size * np.where(crowded, windows, 1)).sum())
                    if held > p.bucket_bytes:
                        yield block(found, turn)
                        found, held, turn = [], 0, turn + 1
        if found:
            yield block(found, turn)
        tn.trim()

    # With the carried columns, though unused, so that the shuffled texts are those that the cut takes too.
    return docs.select("id", "uid", "text", "list", "carried").mapInArrow(run, PACKED)


def repeated_windows(flat: np.ndarray, lead: np.ndarray, windows: np.ndarray, ids: np.ndarray, p: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct segments (flat: their bytes, end to end), each with its least document, the windows
    that also start in one of a smaller document: segment number and window number.

    Segments are laid out so that all anchors have one residue modulo the cover's period: equal
    windows then share a residue, and the cover's ranks decide every tie between them.
    """
    size = windows + p.length - 1
    room = -(-(size + PERIOD) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + (-lead) % PERIOD
    text = np.zeros(int(room.sum()) + p.length, np.uint8)
    text[np.repeat(base - (np.cumsum(size) - size), size) + np.arange(len(flat))] = flat
    owner = np.repeat(np.arange(len(size)), windows)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = base[owner] + number
    order = suffix_order(text, starts, p.length)
    at = starts[order]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    new = np.zeros(len(at), bool)
    new[:1] = True
    steps = [*range(0, p.length - 7, 8), p.length - 8] if p.length >= 8 else range(0)
    for k in steps:
        w = words_at(padded, at + k)
        new[1:] |= w[1:] != w[:-1]
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[owner[order]], heads) if len(heads) else ids[:0]
    marked = np.empty(len(at), bool)
    marked[order] = np.repeat(least, np.diff(np.append(heads, len(at)))) < ids[owner[order]]
    return owner[marked], number[marked]


def _sorted_out(segments: DataFrame, p: Repeats, n_docs: int) -> DataFrame:
    """For documents, the spans that go because a smaller document holds their windows: the suffixes of a
    bucket's segments are sorted, and runs that agree on ``length`` bytes compared by document."""

    def run(rows: pa.Table) -> pa.Table:
        spans, parts, texts = [], [], []
        for kind, n, data in zip(rows["kind"].to_pylist(), rows["n"].to_pylist(), rows["data"], strict=True):
            data = data.as_buffer()
            if kind == GONE:
                spans.append(_unpack(_SPAN, data, n)[0])
                continue
            columns, at = _unpack(_TEXT, data, n)
            parts.append(columns)
            texts.append(np.frombuffer(data, np.uint8, offset=at))
        anchor, ids, uids, start, windows, lead = _together(parts, _TEXT)
        if len(anchor):
            start, windows, lead = (x.astype(np.int64) for x in (start, windows, lead))
            text = np.concatenate(texts)
            del parts, texts
            size = windows + p.length - 1
            at = np.cumsum(size) - size
            # Equal segments are one; its rows are those of its least document, or go.
            _, _, kind = tn.distinct_spans(text, at, at + size)
            order = np.lexsort([ids, lead, kind, anchor])
            new = _groups(anchor[order], kind[order], lead[order])
            heads = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            copied = ids[order] > ids[order[heads]][group]
            own = order[copied]
            spans.append([ids[own], uids[own], start[own], start[own] + size[own]])
            # Whole anchors of several segments, about crowd segments at once.
            pick = order[heads]
            first = np.flatnonzero(_groups(anchor[pick]))
            n_kinds = np.diff(np.append(first, len(pick)))
            several = np.flatnonzero(np.repeat(n_kinds > 1, n_kinds))
            edge = np.cumsum(n_kinds[n_kinds > 1])
            at_head = np.append(heads, len(order))
            lo = 0
            while lo < len(several):
                hi = int(edge[max(np.searchsorted(edge, lo + p.crowd, "right") - 1, np.searchsorted(edge, lo, "right"))])
                some = pick[several[lo:hi]]
                seg, win = repeated_windows(gather(text, at[some], size[some]), lead[some], windows[some], ids[some], p)
                if len(seg):
                    run_first = np.concatenate([[True], (seg[1:] != seg[:-1]) | (win[1:] != win[:-1] + 1)])
                    run_last = np.append(run_first[1:], True)
                    number, a, b = several[lo:hi][seg[run_first]], win[run_first], win[run_last]
                    # What holds for the least document's segment holds for all its rows of that document.
                    many = at_head[number + 1] - at_head[number]
                    which = np.repeat(np.arange(len(number)), many)
                    place = at_head[number][which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                    same = ~copied[place]
                    own, which = order[place[same]], which[same]
                    spans.append([ids[own], uids[own], start[own] + a[which], start[own] + b[which] + p.length])
                lo = hi
        out = pa.Table.from_batches([_packed(_spans(_together(spans, _SPAN), n_docs))])
        tn.trim()
        return out

    return segments.groupBy("bucket").applyInArrow(run, PACKED)


def _cut(docs: DataFrame, whole_chars: bool) -> DataFrame:
    """Take the listed spans out of ``id, uid, text, list, carried``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tn.utf8(batch.column(2))
            lists = batch.column(3)
            kept, removed, spans = [], [], []
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                data = lists[i].as_buffer()
                if data is None:
                    kept.append(text.tobytes())
                    removed.append(0)
                    spans.append(0)
                    continue
                (a, b), _ = _unpack(_SPAN[2:], data, len(data) // 8)
                depth = np.zeros(len(text) + 1, np.int64)
                np.add.at(depth, a, 1)
                np.add.at(depth, b, -1)
                gone = np.cumsum(depth[:-1]) > 0
                if whole_chars:  # a character that loses a byte goes
                    char = np.cumsum((text & 0xC0) != 0x80) - 1
                    gone = (np.bincount(char, gone) > 0)[char]
                kept.append(text[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (np.diff(offsets), removed, spans)), pa.array(kept, pa.binary()), batch.column(4)], names=schema.names)
        tn.trim()

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "n_bytes", "n_removed", "n_spans")]).add("kept", T.BinaryType()).add("carried", docs.schema["carried"].dataType)
    return docs.select("id", "uid", "text", "list", "carried").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, params: Repeats | None = None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), whole_chars: bool = False) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a smaller document.

    Returns ``id_col, n_bytes, n_removed, n_spans, kept`` (the bytes that stay) and the columns of
    ``carry``. Strings are judged on the input. Ids must be integers. With ``whole_chars``, a character
    that loses a byte goes as a whole, so that ``kept`` is UTF-8.

    1. Every window of ``length`` bytes has one anchor, the least-hashed ``gram`` bytes in it; a run of
       windows with one anchor is a segment. A block of text sends, for each segment, only its least
       document's sightings to hash buckets; the others already go. A bucket finds each segment's least
       document, and the anchors whose segments differ.
    2. The text behind such anchors goes to suffix buckets, which order the windows by difference-cover
       blockwise suffix sorting; runs that agree on ``length`` bytes show which windows a smaller
       document holds. Matches are compared byte by byte there; equal segments of step 1 are known by
       their anchor and 96 bits.
    3. An anchor of over ``crowd`` distinct segments is dealt out window by window, each to the bucket
       of its own digest, and sorted there: so no bucket gathers what surrounds a hot passage.

    Null and empty texts, and those under ``length`` bytes, lose nothing. A row of a null id is neither
    compared nor changed. Repeated rows (same id and text) are returned once; different texts of one
    id are compared with other documents, not with each other. A very long text is scanned in pieces
    that overlap. An empty table gives an empty result. Other columns are ignored.
    """
    p = params or Repeats()
    modest_batches(docs)
    spark = docs.sparkSession
    carried = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))) if carry else F.lit(True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), carried.alias("carried"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size, n, n_ids = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1)), F.count_distinct("id")).first()
    unique = n == n_ids  # every id has one text: then it is its own key
    rows = rows.withColumn("uid", F.col("id") if unique else F.xxhash64("id", F.sha2(F.col("text").cast("binary"), 256)))
    # A sighting, some 30 bytes, stands for some 17 bytes of text.
    n_buckets = max(spark.sparkContext.defaultParallelism * 4, -(-2 * (size or 0) // p.bucket_bytes))
    seen = _sightings(rows.filter(f"id IS NOT NULL AND octet_length(text) >= {p.length}"), p, n_buckets)
    n_docs = max(spark.sparkContext.defaultParallelism * 2, -(-(size or 0) // (3 * p.bucket_bytes)))
    found = checkpoint(_resolved(seen, p, n_docs))
    release(spark)
    shrink(spark)
    wanted = found.filter(F.col("kind") == TEXT).agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    n_sorts = max(spark.sparkContext.defaultParallelism * 4, -(-wanted * 2 * p.length // p.bucket_bytes))
    by_id = rows.repartition("id", "uid")  # one shuffle of texts serves both joins
    if not unique:
        by_id = by_id.dropDuplicates(["id", "uid"])
    differing = by_id.join(_by_document(found.filter(F.col("kind") == TEXT), _LIST), ["id", "uid"])
    more = _sorted_out(_segments(differing, p, n_sorts), p, n_docs)
    gone = _by_document(found.filter(F.col("kind") == GONE).unionByName(more), _SPAN)
    cut = _cut(by_id.join(gone, ["id", "uid"], "left"), whole_chars)
    extra = [F.col(f"carried.c{i}").alias(c) for i, c in enumerate(carry)]
    return cut.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", *extra)
