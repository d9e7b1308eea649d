"""Which window hashes occur more than once, without a row per window.

A map task gathers the hashes of its windows in chunks, sorts a chunk, keeps one
entry per distinct hash and deals the sorted runs to hash buckets as packed
blobs (differences of sorted hashes, a few bytes each).  A bucket's task merges
the runs that meet there and answers with the repeated hashes, by document.

A hash that a third of all documents share is one entry per chunk in its bucket:
copies within the chunk are settled where they are.  Answers travel packed too,
by buckets of documents, so that rows follow tasks and documents, not windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bytesops import mix

U = np.uint64
#: Windows that a map task holds before it sorts and deals them out.
CHUNK = 3_000_000
#: Text bytes that are hashed at a time.
SLICE = 1 << 20

ENTRY, KNOWN, ANSWER, RUNS = 0, 1, 2, 3
DEALT = "bucket int, kind int, h binary, d binary"
_DEALT = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("h", pa.binary()), ("d", pa.binary())])
_ANSWERS = pa.schema([("doc_id", pa.int64()), ("h", pa.binary()), ("text_key", pa.list_(pa.int64())),
                      ("runs", pa.list_(pa.binary()))])


def pack(x: np.ndarray) -> bytes:
    """Ascending uint64 values as differences, each in as many bytes as the largest needs."""
    d = np.empty(len(x), np.uint64)
    d[:1] = 0
    np.subtract(x[1:], x[:-1], out=d[1:])
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    planes = d.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + (int(x[0]) if len(x) else 0).to_bytes(8, "little") + planes.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width, n = blob[0], (len(blob) - 9) // blob[0]
    d = np.zeros((n, 8), np.uint8)
    d[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(width, n).T
    d = d.view(np.uint64).reshape(-1)
    if n:
        d[0] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(d, dtype=np.uint64)


def pack_ids(x: np.ndarray) -> bytes:
    """Integers in any order, as offsets from their least."""
    low = int(x.min())
    d = (x - low).astype(np.uint64)
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    planes = d.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + low.to_bytes(8, "little", signed=True) + planes.tobytes()


def unpack_ids(blob: bytes) -> np.ndarray:
    width, n = blob[0], (len(blob) - 9) // blob[0]
    d = np.zeros((n, 8), np.uint8)
    d[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(width, n).T
    return d.view(np.int64).reshape(-1) + int.from_bytes(blob[1:9], "little", signed=True)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    new = np.empty(len(sorted_values), bool)
    new[:1] = True
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    return np.flatnonzero(new)


def _answers(h: np.ndarray, d: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Dealt rows of (hash, document) answers, one for each bucket of documents."""
    to = (mix(d.view(np.uint64)) % U(buckets)).astype(np.int32)
    order = np.lexsort((h, d, to))
    h, d, to = h[order], d[order], to[order]
    at = np.append(_runs(to), len(to))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield int(to[a]), ANSWER, pack_ids(h[a:b].view(np.int64)), pack_ids(d[a:b])


def text_key(text: bytes) -> int:
    """Tells the rows that share a document id apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _runs_of(code: np.ndarray, docs: np.ndarray, keys: np.ndarray,
             buckets: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Dealt rows of answers settled in the task: runs of starts, by document and text.

    ``code``: ascending (row << 32 | place); ``docs`` and ``keys`` by row.
    """
    new = np.ones(len(code), bool)
    new[1:] = code[1:] > code[:-1] + 1
    first = np.flatnonzero(new)
    start, last = code[first], code[np.append(first[1:], len(code)) - 1]
    row = start >> 32
    start, end = start & 0xFFFFFFFF, (last & 0xFFFFFFFF) + 1
    d, key = docs[row], keys[row]
    to = (mix(d.view(np.uint64)) % U(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    d, key, start, end, to = d[order], key[order], start[order], end[order], to[order]
    cut = np.append(_runs(to), len(to))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        blob = b"".join(len(x).to_bytes(4, "little") + x for x in map(pack_ids, (key[a:b], start[a:b], end[a:b])))
        yield int(to[a]), RUNS, blob, pack_ids(d[a:b])


def _unpack_runs(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(unpack_ids(blob[at + 4:at + 4 + n]))
        at += 4 + n
    return out


def _collected(t: pa.Table) -> pa.Table:
    """One row per document: its distinct hash answers, and its runs by text."""
    found: dict[int, list] = {}
    kinds = t.column("kind").to_numpy()
    hs, ds = t.column("h"), t.column("d")
    hashed, placed = np.flatnonzero(kinds == ANSWER).tolist(), np.flatnonzero(kinds == RUNS).tolist()
    if hashed:
        h = np.concatenate([unpack_ids(hs[i].as_buffer()) for i in hashed]).view(np.uint64)
        d = np.concatenate([unpack_ids(ds[i].as_buffer()) for i in hashed])
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[new], d[new]
        at = np.append(_runs(d), len(d))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            found[int(d[a])] = [pack(h[a:b]), [], []]
    if placed:
        parts = [(unpack_ids(ds[i].as_buffer()), *_unpack_runs(hs[i].as_py())) for i in placed]
        d, key, start, end = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, key, d))
        d, key, start, end = d[order], key[order], start[order], end[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (key[1:] != key[:-1])
        at = np.append(np.flatnonzero(new), len(d))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            own = found.setdefault(int(d[a]), [None, [], []])
            own[1].append(int(key[a]))
            own[2].append(np.concatenate((start[a:b], end[a:b])).tobytes())
    rows = [(doc, *x) for doc, x in found.items()]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ANSWERS)], schema=_ANSWERS)


def _settle(h: np.ndarray, d: np.ndarray, known: np.ndarray | None, rule: str):
    """Sort and group: (order, h, d, run starts, mask of rows to answer).

    ``known`` entries were answered where they come from and only tell others.
    """
    order = np.argsort(h)
    h, d = h[order], d[order]
    at = _runs(h)
    n = np.diff(np.append(at, len(h)))
    if rule == "earlier":
        return order, h, d, at, d > np.repeat(np.minimum.reduceat(d, at), n)
    if known is None:
        return order, h, d, at, np.repeat(n > 1, n)
    known = known[order]
    return order, h, d, at, np.repeat((n > 1) | np.logical_or.reduceat(known, at), n) & ~known


class Dealer:
    """Gathers (hash, document) of a task's windows and yields dealt batches."""

    def __init__(self, rule: str, buckets: int, shift: int = 0):
        self.rule, self.buckets, self.shift = rule, buckets, U(shift)
        self.h: list[np.ndarray] = []
        self.d: list[np.ndarray] = []
        self.n = 0

    def add(self, h: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(h):
            self.h.append(h)
            self.d.append(d)
            self.n += len(h)
        if self.n >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        h, d = np.concatenate(self.h) >> self.shift, np.concatenate(self.d)
        self.h, self.d, self.n = [], [], 0
        _, h, d, at, repeats = _settle(h, d, None, self.rule)
        rows = list(_answers(h[repeats], d[repeats], self.buckets)) if repeats.any() else []
        if self.rule == "earlier":
            rows += self._entries(ENTRY, h[at], np.minimum.reduceat(d, at))
        else:
            many = repeats[at]
            rows += self._entries(ENTRY, h[at][~many], d[at][~many])
            rows += self._entries(KNOWN, h[at][many], None)
        yield from _batches(rows)

    def _entries(self, kind: int, x: np.ndarray, ids: np.ndarray | None) -> list[tuple]:
        """Buckets are ranges of the hash, so each takes one run of the ascending hashes."""
        top = (x >> (U(32) - self.shift)) * U(self.buckets) >> U(32)
        cut = np.searchsorted(top, np.arange(self.buckets + 1, dtype=np.uint64)).tolist()
        return [(b, kind, pack(x[lo:hi]), None if ids is None else pack_ids(ids[lo:hi]))
                for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if lo < hi]


class PlacedDealer(Dealer):
    """The same for rule ``any``, with the windows' places: what the task settles
    itself is answered as runs of places instead of hashes."""

    def __init__(self, buckets: int):
        super().__init__("any", buckets)
        self.docs: list[int] = []
        self.keys: list[int] = []

    def add_text(self, doc: int, text: bytes, h: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(h):
            self.h.append(h)
            self.d.append(places | (len(self.docs) << 32))
            self.docs.append(doc)
            self.keys.append(text_key(text))
            self.n += len(h)
        if self.n >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        h, code = np.concatenate(self.h), np.concatenate(self.d)
        docs, keys = np.array(self.docs, np.int64), np.array(self.keys, np.int64)
        self.h, self.d, self.docs, self.keys, self.n = [], [], [], [], 0
        order = np.argsort(h)
        h = h[order]
        at = _runs(h)
        n = np.diff(np.append(at, len(h)))
        settled = code[order[np.repeat(n > 1, n)]]
        settled.sort()
        once = at[n == 1]
        rows = self._entries(ENTRY, h[once], docs[code[order[once]] >> 32])
        rows += self._entries(KNOWN, h[at[n > 1]], None)
        del h, order, code
        if len(settled):
            rows += _runs_of(settled, docs, keys, self.buckets)
        yield from _batches(rows)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 2000):
        yield from _dealt(rows[i:i + 2000]).to_batches()


def _dealt(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _DEALT)],
                                schema=_DEALT)


def _meet(rule: str, buckets: int, cut: int) -> Callable[[pa.Table], pa.Table]:
    def answer(t: pa.Table) -> pa.Table:
        kinds = t.column("kind").to_numpy()
        passed = t.filter(pa.array(kinds >= ANSWER)).cast(_DEALT)
        hs, ds = t.column("h"), t.column("d")
        h, d, known = [], [], []
        for i in np.flatnonzero(kinds < ANSWER).tolist():
            x = unpack(hs[i].as_buffer())
            h.append(x)
            d.append(unpack_ids(ds[i].as_buffer()) if kinds[i] == ENTRY else np.zeros(len(x), np.int64))
            known.append(np.full(len(x), kinds[i] == KNOWN))
        if not h:
            return passed
        h, d, known = np.concatenate(h), np.concatenate(d), np.concatenate(known)
        _, h, d, _, repeats = _settle(h, d, known, rule)
        return pa.concat_tables([passed, _dealt(list(_answers(h[repeats] >> U(cut), d[repeats], buckets)))])

    return answer


def repeated(dealt: DataFrame, rule: str, buckets: int, cut: int = 0) -> DataFrame:
    """Answers by document: ``doc_id``, ``h`` (its packed repeated hashes), and,
    by the key of each of its texts, ``runs`` of window places.

    ``rule``: ``any`` (the hash occurs at another place, in whichever document)
    or ``earlier`` (it occurs in a document with a smaller id).  Answers may leave
    out ``cut`` low bits: they are only compared with one document's own windows.
    """
    met = dealt.groupBy("bucket").applyInArrow(_meet(rule, buckets, cut), DEALT)
    return met.groupBy("bucket").applyInArrow(
        _collected, "doc_id long, h binary, text_key array<long>, runs array<binary>")


def run_places(text: bytes, keys: list[int] | None, runs: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one places (end exclusive) of this text's answered runs."""
    key = text_key(text) if keys else None
    own = [np.frombuffer(r, np.int64).reshape(2, -1) for k, r in zip(keys or [], runs or []) if k == key]
    return tuple(np.concatenate(own, axis=1)) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def among(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Mask of the values of ``x`` that the sorted ``found`` holds."""
    if not len(found):
        return np.zeros(len(x), bool)
    at = np.searchsorted(found, x)
    at[at == len(found)] = 0
    return found[at] == x
