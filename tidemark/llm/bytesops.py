"""Numpy kernels on text bytes: words, rolling hashes, mixing."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Fixed odd multipliers of the rolling hashes.
BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Fixed multipliers of the 64-bit finaliser (public murmur3 mixing constants).
MIX1, MIX2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
#: Text bytes for which power tables are made at a time.
SEGMENT = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_pow = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * U(MIX1)
    x ^= x >> U(33)
    x *= U(MIX2)
    x ^= x >> U(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if _pow.get("n", -1) < n:
        size = max(n, SEGMENT + 1)
        out = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, U(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 4 * SEGMENT:  # tables for one very long text are not kept
            return out[0][:n], out[1][:n]
        _pow.update(n=size, p=out[0], q=out[1])
    return _pow["p"][:n], _pow["q"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = hash of data[s:e] times BASE**s (modulo 2**64)."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


def window_hash(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Mixed Rabin-Karp hash of every ``width`` bytes (or of those that start ``at``).

    Equal for equal strings wherever they stand.  Works segment by segment, so
    that the tables stay small for very long texts.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if at is not None:
        out = np.empty(len(at), np.uint64)
    else:
        out = np.empty(n, np.uint64)
    for lo in range(0, n, SEGMENT):
        hi = min(lo + SEGMENT, n)
        if at is not None:
            a, b = np.searchsorted(at, (lo, hi))
            if a == b:
                continue
            idx = at[a:b] - lo
        p = prefix_hash(data[lo:hi + width - 1])
        q = powers(hi - lo)[1]
        if at is None:
            out[lo:hi] = (p[width:] - p[:-width]) * q
        else:
            out[a:b] = (p[idx + width] - p[idx]) * q[idx]
    return mix(out)


def _cuts(space: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places to cut at, about every SEGMENT bytes, never inside a word."""
    n, cuts = len(space), [0]
    while cuts[-1] < n:
        at = cuts[-1] + SEGMENT
        if at >= n:
            cuts.append(n)
            break
        while at < n and not space[at]:
            k = np.flatnonzero(space[at:at + SEGMENT])
            nxt = at + (int(k[0]) if len(k) else SEGMENT)
            border = int(offsets[min(np.searchsorted(offsets, at), len(offsets) - 1)])
            at = border if at <= border < nxt else nxt
            if at == border:
                break
        cuts.append(min(at, n))
    return np.array(cuts)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each document: n + 1 counts).

    A word is a run of bytes other than blank and 0x09-0x0D; words never cross
    documents.  ``lower`` folds A-Z.
    """
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = word_spans(data, offsets)
    return span_hashes(data, offsets, starts, ends, _SPACE, lower), np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, between: np.ndarray,
                lower: bool) -> np.ndarray:
    """Hash of each span; the bytes for which the table ``between`` holds are in none."""
    if lower:
        data = _LOWER[data]
    out = np.empty(len(starts), np.uint64)
    cuts = _cuts(between[data], offsets)
    at = np.searchsorted(starts, cuts)
    for lo, hi, a, b in zip(cuts[:-1], cuts[1:], at[:-1], at[1:]):
        if a == b:
            continue
        p, q = prefix_hash(data[lo:hi]), powers(hi - lo + 1)[1]
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (p[e] - p[s]) * q[s]
    return mix(out)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every run of bytes that are not ``between``."""
    inside = ~between[data]
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    first[borders] = True
    first &= inside
    last = np.empty(len(data), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[borders - 1] = True
    last &= inside
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_windows(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every ``width`` consecutive words within one document.

    ``counts``: words before each document, as ``words`` gives them.  The result
    follows the words' order, so the k-th window of a document starts at its
    k-th word.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n].copy()
    for k in range(1, width):
        h *= U(STEP)
        h += hashes[k:n + k]
    doc = np.repeat(np.arange(len(counts) - 1), np.diff(counts))
    ok = doc[:n] == doc[width - 1:]
    return mix(h[ok]), doc[:n][ok]


def distinct_by_doc(values: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, and n_docs + 1 offsets.
    ``doc`` ascends."""
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    out, counts = [], np.zeros(n_docs + 1, np.int64)
    for i in range(n_docs):
        if at[i] < at[i + 1]:
            v = np.unique(values[at[i]:at[i + 1]])
            out.append(v)
            counts[i + 1] = len(v)
    return (np.concatenate(out) if out else np.zeros(0, values.dtype)), np.cumsum(counts)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of n places that some interval [start, end) covers."""
    step = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(np.minimum(ends, n), minlength=n + 1)
    return np.cumsum(step[:-1]) > 0


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
