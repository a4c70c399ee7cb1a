"""Exact substring dedup with per-shard suffix arrays.

Every byte covered by a ``WINDOW``-byte string that also starts in a document with a
smaller doc_id is removed. Shipping every suffix would multiply the corpus by the window
length, so windows are brought together by their minimizer (the smallest hash of the
``GRAM``-byte strings inside the window): equal windows have equal minimizers, and a run
of consecutive windows with one minimizer travels as one segment of bytes.

1. Every document lists its minimizers. A minimizer held by one document only proves its
   windows unique; those windows are done.
2. Documents cut out the segments of the shared minimizers, dealt to shards by minimizer.
3. A shard sorts the suffixes of its segments (Larsson-Sadakane: ranks by doubled prefix
   lengths, only unsorted groups are refined), computes the neighbours' common prefixes in
   text order as Kasai does, and finds the smallest document of each class of equal
   windows. A minimizer whose segments exceed one shard is spread over several; their
   sorted distinct windows are merged, and each shard looks its own up by binary search.
4. The covered bytes go back to their documents.

Memory: the minimizers are dealt to buckets whose number follows from the bytes of all
texts. Partitions come sorted by bucket, and a task holds one bucket after the other, so a
worker's need does not grow with the corpus. The segments of one minimizer stay together.

Disk: what travels is packed: sorted minimizers as differences within their bucket, each
document's hash once a row, numbers byte by place, all of it and the segments' bytes
compressed. The shuffle files of the lists are removed before the segments are sent.

Hot groups: equal texts are found by one aggregate and only the smallest document takes
part. Rows that share an id or have none are told apart by their texts. Inside a chunk of documents, a minimizer is sent on once, and equal segments are
settled on the spot, so a passage that a third of all documents share sends one segment
per chunk.

Defined results: null text is empty; a null doc_id counts as the smallest id; rows with
one doc_id do not remove each other's bytes; texts of any length are taken whole; an
empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import range_partitions, text_of, written
from orderlake.session import shuffles_removed

WINDOW, GRAM = 50, 20
CHUNK = 16 << 20  # bytes of text a task holds before it sends on
SHARD = 1 << 20   # bytes of segments sorted at once
BUCKET = 16 << 20  # bytes of text whose minimizers and segments share a bucket
NO_ID = -(1 << 63)
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _words(data: np.ndarray) -> np.ndarray:
    """The big-endian 8-byte word at every byte (zeros beyond the end)."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    n = len(data)
    two = (padded[:n + 7] << np.uint64(8)) | padded[1:n + 8]
    four = (two[:n + 5] << np.uint64(16)) | two[2:n + 7]
    return (four[:n + 1] << np.uint64(32)) | four[4:n + 5]


def minimizers(data: np.ndarray) -> np.ndarray:
    """The minimizer of every window of ``data``."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    w = _words(data)
    grams = len(data) - GRAM + 1
    h = w[:grams] * _C[0] + w[8:8 + grams] * _C[1] + w[GRAM - 8:GRAM - 8 + grams] * _C[2]
    h ^= h >> np.uint64(32)
    h *= _C[3]
    h >>= np.uint64(16)  # 48 bits: two that meet by chance only share a list, windows are compared whole
    span, low = WINDOW - GRAM + 1, h
    width = 1
    while 2 * width <= span:  # minima of doubled widths, then two overlapping ones
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    return np.minimum(low[:n], low[rest:rest + n])


def runs_of(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the runs of equal values."""
    if not len(m):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    cut = np.flatnonzero(m[1:] != m[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(m)]])


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``data`` in order of their first ``depth`` bytes or more."""
    n = len(data)
    key = _words(data)[:n]
    sa = n - 1 - np.argsort(key[::-1], kind="stable")  # of equal words the shorter suffix first
    ordered, short = key[sa], sa > n - 8
    head = np.concatenate([[True], (ordered[1:] != ordered[:-1]) | short[1:] | short[:-1]])
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = 0
    place = np.flatnonzero(head)
    rank[sa] = np.repeat(place, np.diff(np.append(place, n))) + 1
    h = 8
    while h < depth:
        single = head & np.append(head[1:], True)
        slots = np.flatnonzero(~single)
        if not len(slots):
            break
        own = sa[slots]
        pair = rank[own] * (n + 2) + rank[np.minimum(own + h, n)]
        order = np.argsort(pair)
        sa[slots] = own[order]
        pair = pair[order]
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        head[slots] = new
        first = slots[new]
        rank[sa[slots]] = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(slots)))) + 1
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each suffix shares with its predecessor in ``sa``, at most ``cap``: the
    permuted array in text order, eight bytes a step for all suffixes still equal (the
    sequential scan of Kasai's method, which carries one value from suffix to suffix, is
    replaced by that; with a cap both are linear)."""
    n = len(data)
    lcp = np.zeros(n, dtype=np.int64)
    if n < 2:
        return lcp
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    w = _words(data)
    live = np.flatnonzero(before >= 0)
    for at in range(0, cap, 8):
        a, b = live + at, before[live] + at
        x = w[np.minimum(a, n)] ^ w[np.minimum(b, n)]
        same = x == 0
        part = x[~same]
        equal = np.zeros(len(part), dtype=np.int64)
        for k in range(1, 8):
            equal += (part >> np.uint64(64 - 8 * k)) == 0
        lcp[live[~same]] = at + equal
        live = live[same]
        lcp[live] = at + 8
    lcp = np.minimum(lcp, n - np.maximum(np.arange(n), np.maximum(before, 0)))
    return np.minimum(lcp, cap)[sa]


class Shard:
    """Sorted suffixes of segments; the smallest document of every class of equal windows."""

    def __init__(self, segments: list[bytes], docs: np.ndarray):
        self.data = np.frombuffer(b"".join(segments), dtype=np.uint8)
        sizes = np.array([len(s) for s in segments])
        ends = np.cumsum(sizes)
        self.starts = ends - sizes
        n = len(self.data)
        where = np.repeat(np.arange(len(segments)), sizes)
        whole = np.arange(n) <= ends[where] - WINDOW  # windows that do not leave their segment
        self.sa = suffix_array(self.data, WINDOW)
        lcp = common_prefixes(self.data, self.sa, WINDOW)
        heads = np.flatnonzero(np.concatenate([[True], lcp[1:] < WINDOW]))
        held = np.where(whole, docs[where], np.iinfo(np.int64).max)
        self.smallest = np.minimum.reduceat(held[self.sa], heads)
        self.class_of = np.empty(n, dtype=np.int64)
        self.class_of[self.sa] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
        self.whole, self.where, self.docs, self.heads = whole, where, docs, heads

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct windows and their class numbers."""
        n = len(self.sa)
        place = np.where(self.whole[self.sa], np.arange(n), n)
        first = np.minimum.reduceat(place, self.heads)  # a window of each class that stays in its segment
        number = np.flatnonzero(first < n)
        if not len(number):
            return np.empty(0, dtype=f"S{WINDOW}"), number
        every = np.lib.stride_tricks.sliding_window_view(self.data, WINDOW)
        return np.ascontiguousarray(every[self.sa[first[number]]]).view(f"S{WINDOW}").ravel(), number

    def repeated(self) -> Iterator[tuple[int, int, int]]:
        """(segment, first, last + 1) of runs of windows that start in a smaller document."""
        flag = self.whole & (self.docs[self.where] > self.smallest[self.class_of])
        tag = np.where(flag, self.where, -1)
        first, last = runs_of(tag)
        for a, b in zip(first, last):
            if tag[a] >= 0:
                yield int(tag[a]), int(a - self.starts[tag[a]]), int(b - self.starts[tag[a]])


def hash_windows(windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of an array of windows."""
    h = np.zeros(len(windows), dtype=np.uint64)
    raw = windows.view(np.uint8).reshape(len(windows), WINDOW)
    for at in [*range(0, WINDOW - 8, 8), WINDOW - 8]:
        h = (h ^ np.ascontiguousarray(raw[:, at:at + 8]).view(np.uint64).ravel()) * _C[0]
        h ^= h >> np.uint64(31)
    return h


def merge_shards(shards: list[Shard]) -> None:
    """Lower each class's smallest document to that of the other shards' equal windows: the
    shards' sorted windows are merged once, and each shard finds its own by binary search."""
    tables = [s.distinct() for s in shards]
    # a window whose hash no other has is held by one shard only
    hashes = [hash_windows(w) for w, _ in tables]
    every, count = np.unique(np.concatenate(hashes), return_counts=True)
    several = every[count > 1]
    if not len(several):
        return
    met = [several[np.minimum(np.searchsorted(several, h), len(several) - 1)] == h for h in hashes]
    tables = [(w[k], c[k]) for (w, c), k in zip(tables, met)]
    windows = np.concatenate([w for w, _ in tables])
    least = np.concatenate([s.smallest[c] for s, (_, c) in zip(shards, tables)])
    order = np.argsort(windows, kind="stable")
    windows, least = windows[order], least[order]
    heads = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
    windows, least = windows[heads], np.minimum.reduceat(least, heads)
    for s, (own, c) in zip(shards, tables):
        s.smallest[c] = least[np.searchsorted(windows, own)]


def settle(marks: np.ndarray, docs: np.ndarray, segments: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(segment number, first, last + 1) of repeated windows among segments, grouped by
    minimizer into shards. Of equal segments only the smallest document's is sorted."""
    least: dict[bytes, int] = {}
    held_by = docs.tolist()
    for i, s in zip(held_by, segments):
        if i < least.get(s, i + 1):
            least[s] = i
    own = np.fromiter((i == least[s] for i, s in zip(held_by, segments)), dtype=bool, count=len(segments))
    for n in np.flatnonzero(~own).tolist():
        yield n, 0, len(segments[n]) - WINDOW + 1
    order = np.flatnonzero(own)
    order = order[np.argsort(marks[order])]
    first, last = runs_of(marks[order])
    several = np.flatnonzero(last - first > 1)  # a minimizer of one segment repeats nothing
    first, last = first[several], last[several]
    size = np.array([len(s) for s in segments], dtype=np.int64)
    batch: list[int] = []
    held = 0

    def one(own: list[int]) -> Iterator[tuple[int, int, int]]:
        if own:
            for seg, a, b in Shard([segments[i] for i in own], docs[own]).repeated():
                yield own[seg], a, b

    for a, b in zip(first, last):
        own = order[a:b]
        total = int(size[own].sum())
        if total > SHARD:  # one minimizer, several shards
            ends = np.cumsum(size[own]) // SHARD
            parts = [own[ends == k].tolist() for k in np.unique(ends)]
            shards = [Shard([segments[i] for i in p], docs[p]) for p in parts]
            merge_shards(shards)
            for p, s in zip(parts, shards):
                for seg, x, y in s.repeated():
                    yield p[seg], x, y
            continue
        if held + total > SHARD:
            yield from one(batch)
            batch, held = [], 0
        batch += own.tolist()
        held += total
    yield from one(batch)


_I64, _I32, _U64, _U8 = np.dtype("<i8"), np.dtype("<i4"), np.dtype("<u8"), np.dtype("u1")


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expand(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _pack(values, kind=_I64) -> bytes:
    """Numbers, byte by place (the upper ones of small numbers are zeros), compressed."""
    v = np.ascontiguousarray(values, dtype=kind)
    return _squeeze(v.view(_U8).reshape(-1, kind.itemsize).T.tobytes())


def _unpack(packed: bytes, kind=_I64) -> np.ndarray:
    planes = np.frombuffer(_expand(packed), dtype=_U8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)), values.dtype)


def _unpack_sorted(packed: bytes, kind=_U64) -> np.ndarray:
    return np.cumsum(_unpack(packed, kind), dtype=kind)


def _pack_hashes(h: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct document hashes and the place of each row's among them."""
    table, at = np.unique(h.view(_U64), return_inverse=True)
    return _pack_sorted(table), _pack(at, _I32)


def _unpack_hashes(table: bytes, at: bytes) -> np.ndarray:
    return _unpack_sorted(table)[_unpack(at, _I32)].view(_I64)


def _bucket(m: np.ndarray, n: int) -> np.ndarray:
    return (m % np.uint64(n)).astype(np.int64)


def _by_bucket(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """Each bucket and its rows, one after the other; the batches come sorted by bucket."""
    at, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *names))):
            if bucket != at and held:
                yield at, held
                held = []
            at = bucket
            held.append(tuple(row))
    if held:
        yield at, held


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])


def _list_minimizers(n_buckets: int):
    """Documents (hashes, docs) and minimizers (marks), in order of the latter. Rows that ask the
    minimizer's bucket say which are known to be shared; those without ``known`` are answers."""
    fields = [("bucket", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("marks", pa.binary()), ("known", pa.binary())]

    def send(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        own_hash = np.array([h for h, _ in held], dtype=np.int64)
        docs = np.repeat(np.arange(len(held)), [len(m) for _, m in held])
        marks = np.concatenate([m for _, m in held])
        order = np.argsort(marks, kind="stable")
        docs, marks = docs[order], marks[order]
        first, last = runs_of(marks)
        known = last - first > 1  # held by two documents of this chunk already
        inside = np.repeat(known, last - first)
        rows = [(*row, None) for row in _answers(own_hash[docs[inside]], marks[inside], n_buckets)]
        to = _bucket(marks[first], n_buckets)
        by = np.argsort(to, kind="stable")
        for a, b in zip(*runs_of(to[by])):
            own = first[by[a:b]]
            rows.append((int(to[by[a]]), *_pack_hashes(own_hash[docs[own]]), _pack_sorted(marks[own] // np.uint64(n_buckets)),
                         _pack(known[by[a:b]], _U8)))
        return _batch(rows, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for h, t in zip(batch.column("hash").to_pylist(), batch.column("text")):
                data = np.frombuffer(t.as_py().encode(), dtype=np.uint8)
                m = minimizers(data)
                if len(m):
                    held.append((h, np.unique(m[runs_of(m)[0]])))
                    size += len(data)
                if size >= CHUNK:
                    yield send(held)
                    held, size = [], 0
        if held:
            yield send(held)

    return run


def _answers(h: np.ndarray, m: np.ndarray, n_buckets: int) -> list[tuple]:
    """Shared minimizers (in order) of documents, a row for each bucket of documents."""
    to = _bucket(h.view(_U64), n_buckets)
    by = np.argsort(to, kind="stable")
    return [(int(to[by[a]]), *_pack_hashes(h[by[a:b]]), _pack_sorted(m[by[a:b]])) for a, b in zip(*runs_of(to[by]))]


def _reply_shared(n_buckets: int):
    """Shared minimizers per document, packed by the bucket of the document."""
    fields = [("bucket", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("marks", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches, ["hashes", "docs", "marks", "known"]):
            answered = [(bucket, *row[:3]) for row in rows if row[3] is None]
            if answered:  # within a chunk
                yield _batch(answered, fields)
            asked = [row for row in rows if row[3] is not None]
            del rows
            if not asked:
                continue
            m = np.concatenate([_unpack_sorted(m) for _, _, m, _ in asked]) * np.uint64(n_buckets) + np.uint64(bucket)
            h = np.concatenate([_unpack_hashes(t, d) for t, d, _, _ in asked])
            k = np.concatenate([_unpack(k, _U8) for _, _, _, k in asked])
            order = np.argsort(m, kind="stable")
            first, last = runs_of(m[order])
            ask = order[np.repeat(last - first > 1, last - first)]
            ask = ask[k[ask] == 0]  # the others have their answer
            if len(ask):
                yield _batch(_answers(h[ask], m[ask], n_buckets), fields)

    return run


def _gather_replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: all its shared minimizers."""
    fields = [("hash", pa.int64()), ("marks", pa.binary())]
    for _, rows in _by_bucket(batches, ["hashes", "docs", "marks"]):
        h = np.concatenate([_unpack_hashes(t, d) for t, d, _ in rows])
        m = np.concatenate([_unpack_sorted(m) for _, _, m in rows])
        by = np.argsort(h, kind="stable")
        h, m = h[by], m[by]
        first, last = runs_of(h)
        for k in range(0, len(first), 20_000):
            yield _batch([(int(h[a]), np.unique(m[a:b]).tobytes()) for a, b in zip(first[k:k + 20_000], last[k:k + 20_000])], fields)


def _cut_segments(n_buckets: int):
    fields = [("bucket", pa.int64()), ("marks", pa.binary()), ("ids", pa.binary()), ("hashes", pa.binary()), ("docs", pa.binary()),
              ("starts", pa.binary()), ("sizes", pa.binary()), ("bytes", pa.binary())]

    def send(held: dict[bytes, list]) -> pa.RecordBatch:
        marks, docs, hashes, starts, segs, rows, found = [], [], [], [], [], [], []
        for seg, own in held.items():
            nameless = min(own)
            smallest = nameless[0]
            for i, h, start, mark in own:
                if i > smallest:  # equal segments: settled here
                    found.append((i, h, start, start + len(seg)))
                elif i != NO_ID or (i, h, start, mark) == nameless:  # of those without id one is enough
                    marks.append(mark)
                    docs.append(i)
                    hashes.append(h)
                    starts.append(start)
                    segs.append(seg)
        if found:
            i, h, a, b = zip(*found)
            rows.append((found[0][1] % n_buckets, None, _pack(i), *_pack_hashes(np.array(h, dtype=np.int64)),
                         _pack(a, _I32), _pack(b, _I32), None))
        m = np.array(marks, dtype=np.uint64)
        docs, hashes, starts = (np.array(x, dtype=np.int64) for x in (docs, hashes, starts))
        to = _bucket(m, n_buckets)
        by = np.lexsort((m, to))
        for a, b in zip(*runs_of(to[by])):
            own = by[a:b]
            rows.append((int(to[own[0]]), _pack_sorted(m[own] // np.uint64(n_buckets)), _pack(docs[own]), *_pack_hashes(hashes[own]),
                         _pack(starts[own], _I32), _pack([len(segs[i]) for i in own], _I32),
                         _squeeze(b"".join([segs[i] for i in own]))))
        return _batch(rows, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            for i, h, t, lists, copy in zip(*(batch.column(c).to_pylist() if c != "text" else batch.column(c)
                                              for c in ("id", "hash", "text", "marks", "copy"))):
                if copy:
                    continue
                raw = t.as_py().encode()
                m = minimizers(np.frombuffer(raw, dtype=np.uint8))
                if not len(m):
                    continue
                first, last = runs_of(m)
                shared = np.frombuffer(lists, dtype=np.uint64)
                at = np.minimum(np.searchsorted(shared, m[first]), len(shared) - 1)
                for r in np.flatnonzero(shared[at] == m[first]):
                    a, b = int(first[r]), int(last[r]) + WINDOW - 1
                    held.setdefault(raw[a:b], []).append((i, h, a, int(m[a])))
                    size += b - a + 100
                if size >= 2 * CHUNK:
                    yield send(held)
                    held, size = {}, 0
        if held:
            yield send(held)

    return run


def _settle_segments(n_buckets: int):
    """Repeated spans, packed by the bucket of their document."""
    fields = [("bucket", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("ids", pa.binary()),
              ("first", pa.binary()), ("last", pa.binary())]

    def send(i, h, a, b) -> pa.RecordBatch:
        to = _bucket(h.view(_U64), n_buckets)
        by = np.argsort(to, kind="stable")
        rows = []
        for x, y in zip(*runs_of(to[by])):
            own = by[x:y]
            rows.append((int(to[own[0]]), *_pack_hashes(h[own]), i[own].tobytes(), _pack(a[own], _I32), _pack(b[own], _I32)))
        return _batch(rows, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches, ["marks", "ids", "hashes", "docs", "starts", "sizes", "bytes"]):
            for mark, i, table, at, a, b, _ in rows:
                if mark is None:  # found within a chunk
                    yield send(_unpack(i), _unpack_hashes(table, at), _unpack(a, _I32), _unpack(b, _I32))
            rows = [row for row in rows if row[0] is not None]
            if not rows:
                continue
            marks = np.concatenate([_unpack_sorted(row[0]) for row in rows]) * np.uint64(n_buckets) + np.uint64(bucket)
            ids = np.concatenate([_unpack(row[1]) for row in rows])
            hashes = np.concatenate([_unpack_hashes(row[2], row[3]) for row in rows])
            starts, sizes = (np.concatenate([_unpack(row[c], _I32) for row in rows]) for c in (4, 5))
            ends = np.cumsum(sizes.astype(np.int64))
            raw = b"".join([_expand(row[6]) for row in rows])
            del rows
            segments = [raw[e - z:e] for e, z in zip(ends.tolist(), sizes.tolist())]
            del raw
            out = [(n, starts[n] + a, starts[n] + b + WINDOW - 1) for n, a, b in settle(marks, ids, segments)]
            if out:
                n, a, b = (np.array(x, dtype=np.int64) for x in zip(*out))
                yield send(ids[n], hashes[n], a, b)

    return run


def _gather_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document hash: all repeated spans of its rows."""
    fields = [("hash", pa.int64()), ("ids", pa.binary()), ("first", pa.binary()), ("last", pa.binary())]
    for _, rows in _by_bucket(batches, ["hashes", "docs", "ids", "first", "last"]):
        h = np.concatenate([_unpack_hashes(row[0], row[1]) for row in rows])
        i = np.frombuffer(b"".join([row[2] for row in rows]), dtype=_I64)
        a, b = (np.concatenate([_unpack(row[c], _I32) for row in rows]) for c in (3, 4))
        by = np.argsort(h, kind="stable")
        h, i, a, b = h[by], i[by], a[by], b[by]
        first, last = runs_of(h)
        for k in range(0, len(first), 20_000):
            yield _batch([(int(h[x]), i[x:y].tobytes(), a[x:y].tobytes(), b[x:y].tobytes())
                          for x, y in zip(first[k:k + 20_000], last[k:k + 20_000])], fields)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, spans, kept = [], [], [], []
        for i, t, copy, ids, first, last in zip(*(batch.column(c).to_pylist() if c != "text" else batch.column(c)
                                                  for c in ("id", "text", "copy", "ids", "first", "last"))):
            raw = t.as_py().encode()
            own = np.frombuffer(ids or b"", dtype=_I64) == i
            if copy and len(raw) >= WINDOW:
                left, n = b"", 1
            elif own.any():
                step = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(step, np.frombuffer(first, dtype=_I32)[own], 1)
                np.add.at(step, np.frombuffer(last, dtype=_I32)[own], -1)
                gone = np.cumsum(step)[:-1] > 0
                left = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                n = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            else:
                left, n = raw, 0
            size.append(len(raw))
            removed.append(len(raw) - len(left))
            spans.append(n)
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None if i == NO_ID else i for i in batch.column("id").to_pylist()], pa.int64()), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    spark = docs.sparkSession
    n = range_partitions(spark)
    # the smallest id stands for null; rows are addressed by a hash of id and text (two that
    # share one would share their lists of minimizers, and are told apart by id after that)
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID).cast("long")).alias("id"), text_of().alias("text")) \
        .withColumn("hash", F.xxhash64("id", "text"))
    texts = written(rows.select("id", "hash", F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"),
                                F.octet_length("text").cast("long").alias("size")), "sd-texts")
    several = written(texts.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                      .filter("least < most").select("key", "least"), "sd-several")
    copies = texts.join(several, "key").filter("id > least").groupBy("hash").agg(F.collect_set("id").alias("copies"))
    buckets = max(n, (texts.agg(F.sum("size")).first()[0] or 0) // BUCKET)

    def by_bucket(df: DataFrame) -> DataFrame:
        return df.repartition(n, "bucket").sortWithinPartitions("bucket")

    listed = rows.mapInArrow(_list_minimizers(buckets), "bucket long, hashes binary, docs binary, marks binary, known binary")
    replies = by_bucket(listed).mapInArrow(_reply_shared(buckets), "bucket long, hashes binary, docs binary, marks binary")
    shared = by_bucket(replies).mapInArrow(_gather_replies, "hash long, marks binary")
    with shuffles_removed(spark):  # nothing below reads the lists again
        notes = written(shared.join(copies, "hash", "full"), "sd-notes")

    # the texts are dealt once; both joins below read the same exchange
    dealt = rows.repartition(n, "hash")
    noted = dealt.join(notes.hint("shuffle_merge"), "hash", "left").withColumn("copy", F.array_contains("copies", F.col("id")))
    segments = noted.filter("marks is not null").select("id", "hash", "text", "marks", "copy").mapInArrow(
        _cut_segments(buckets), "bucket long, marks binary, ids binary, hashes binary, docs binary, starts binary, sizes binary, bytes binary")
    spans = by_bucket(segments).mapInArrow(
        _settle_segments(buckets), "bucket long, hashes binary, docs binary, ids binary, first binary, last binary")
    flagged = by_bucket(spans).mapInArrow(_gather_spans, "hash long, ids binary, first binary, last binary")
    return (noted.select("id", "hash", "text", "copy").join(flagged.hint("shuffle_merge"), "hash", "left")
            .select("id", "text", "copy", "ids", "first", "last")
            .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
