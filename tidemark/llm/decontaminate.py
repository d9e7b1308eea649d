"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names and units turn into typed
placeholders, other words are folded.  Windows of template tokens are joined by
hash with the benchmark's; along a matched run the placeholders' values must map
one to one (a number that stands for two different numbers is no re-use of the
question with other values), and the longest consistent run decides.

Verbatim copies are found besides by the words alone, whatever they are: windows
of words as they stand are joined by hash, so items that are mostly numbers, names
or units are not lost.  Scripts without blanks between words have their characters
as words.

The benchmark is joined block by block, each block of bounded size, so that the
documents stay where they are and only matches leave a task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bytesops import STEP, mix, span_hashes, word_spans, word_windows
from tidemark.llm.common import doc_slices, table, text_buffer, texts

U = np.uint64
#: Template tokens of a window, literal words that it must hold, and tokens of a
#: consistent run that make a document contaminated (or the whole item, if shorter).
WINDOW, LITERALS, RUN = 8, 5, 10
#: Words of the shortest item that is looked for verbatim (fewer words stand in too many clean texts);
#: longer ones than RUN words match by any RUN of them.
SHORTEST = 4
#: Text bytes of the benchmark that are joined at a time (the bound of a broadcast).
BLOCK_BYTES = 8_000_000
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3
#: Words that are units after a number.
UNITS = ("%", "am", "cm", "days", "degrees", "dollars", "euros", "feet", "ft", "g", "gb", "grams", "hours", "hz", "inches",
         "kb", "kg", "kilograms", "kilometers", "km", "l", "lb", "lbs", "liters", "litres", "m", "mb", "meters", "metres",
         "mg", "miles", "minutes", "ml", "mm", "months", "mph", "ms", "ounces", "oz", "percent", "pm", "pounds", "s",
         "seconds", "w", "watts", "weeks", "yards", "years")
_PLACE = (U(0), U(0x11), U(0x22), U(0x33))

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, *b".!?:\"|"]] = True


class Templates(NamedTuple):
    """Template tokens of some texts: hash of the template, hash of the value, kind, and texts' offsets;
    hashes of the words in them, texts' offsets in these, and the token that each word is in."""

    template: np.ndarray
    value: np.ndarray
    kind: np.ndarray
    counts: np.ndarray
    words: np.ndarray
    word_counts: np.ndarray
    token: np.ndarray


def fold(data: np.ndarray) -> np.ndarray:
    """Small letters for A-Z and the Latin-1 capitals (two bytes, 0xC3 and 0x80-0x9E but the cross)."""
    out = data.copy()
    out[_UPPER[data]] += 32
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[second] += 32
    return out


def _unit_hashes() -> np.ndarray:
    raw = [u.encode() for u in UNITS if u != "%"]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    offsets = np.array([0, len(data)])
    starts, ends = word_spans(data, offsets, _BETWEEN)
    return np.sort(span_hashes(data, offsets, starts, ends, _BETWEEN, True))


_UNIT_HASHES = _unit_hashes()


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each character of the scripts that put no blanks between words: Thai,
    Lao, Tibetan, Myanmar, Khmer, Chinese and Japanese, with their wide signs."""
    at = np.flatnonzero(data >= 0xE0)
    lead, then = data[at], data[np.minimum(at + 1, len(data) - 1)]
    three = ((lead == 0xE0) & (then >= 0xB8) | (lead == 0xE1) & ((then <= 0x82) | (then == 0x9E) | (then == 0x9F))
             | (lead == 0xE3) | (lead >= 0xE4) & (lead <= 0xE9)
             | (lead == 0xEF) & ((then >= 0xA4) & (then <= 0xAB) | (then >= 0xBC) & (then <= 0xBE)))
    four = (lead == 0xF0) & (then >= 0xA0)
    ok = three | four
    return at[ok], at[ok] + np.where(four[ok], 4, 3)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words' starts and ends; a character of a script without blanks is a word."""
    starts, ends = word_spans(data, offsets, _BETWEEN)
    first, last = _characters(data)
    if len(first):
        within = np.searchsorted(starts, first, "right") - 1
        before, after = first[first > starts[within]], last[last < ends[within]]
        starts = np.unique(np.concatenate((starts, first, after)))
        ends = np.unique(np.concatenate((ends, before, last)))
    return starts, ends


def templates(data: np.ndarray, offsets: np.ndarray) -> Templates:
    """A number holds a digit (parts joined by a point or comma are one); a name
    begins with a capital followed by a small letter, not at the start of a
    sentence or line (neighbouring names are one); a unit follows a number."""
    none, no_words = np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if len(data) == 0:
        return Templates(none, none, np.zeros(0, np.int8), no_words, none, no_words, np.zeros(0, np.int64))
    starts, ends = _spans(data, offsets)
    counts = np.searchsorted(starts, offsets)
    n = len(starts)
    if n == 0:
        return Templates(none, none, np.zeros(0, np.int8), counts, none, counts, np.zeros(0, np.int64))
    value = span_hashes(fold(data), offsets, starts, ends, _BETWEEN, False)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    stops = np.concatenate(([0], np.cumsum(_STOP[data])))
    number = digits[ends] > digits[starts]
    first = np.zeros(n, bool)
    first[counts[:-1][counts[:-1] < n]] = True
    begins = first.copy()
    begins[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    second = data[np.minimum(starts + 1, len(data) - 1)]
    name = _UPPER[data[starts]] & ~begins & (ends - starts > 1) & ~_UPPER[second] & ~number
    gap = np.zeros(n, np.int64)
    gap[1:] = starts[1:] - ends[:-1]
    at = np.searchsorted(_UNIT_HASHES, value)
    at[at == len(_UNIT_HASHES)] = 0
    unit = np.zeros(n, bool)
    unit[1:] = (_UNIT_HASHES[at[1:]] == value[1:]) & number[:-1] & ~first[1:] & ~number[1:]
    kind = np.select([number, name, unit], [NUMBER, NAME, UNIT], LITERAL).astype(np.int8)
    # a part that continues the placeholder before it belongs to that one
    joint = np.zeros(n, bool)
    joiner = data[np.maximum(starts - 1, 0)]
    joint[1:] = ~first[1:] & (number[1:] & number[:-1] & (gap[1:] == 1) & ((joiner[1:] == 46) | (joiner[1:] == 44))
                              | name[1:] & name[:-1] & (gap[1:] == 1))
    head = np.flatnonzero(~joint)
    ends_of = np.append(head[1:], n) - 1
    # one value for all parts: a hash from the first's start to the last's end
    merged = value[head].copy()
    several = np.flatnonzero(ends_of > head)
    for k in several.tolist():
        h = 0
        for v in value[head[k]:ends_of[k] + 1].tolist():
            h = (h * 0x100000001B3 + v) % (1 << 64)
        merged[k] = h
    kind = kind[head]
    template = np.where(kind == LITERAL, merged, np.array(_PLACE, np.uint64)[kind])
    return Templates(template, merged, kind, np.searchsorted(head, counts), value, counts, np.cumsum(~joint) - 1)


def _windows(t: Templates, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place in the text) of the windows with enough literal words."""
    h, doc = word_windows(t.template, t.counts, width)
    per = np.maximum(np.diff(t.counts) - width + 1, 0)
    at = np.arange(len(h)) - np.repeat(np.cumsum(per) - per, per)
    literal = np.concatenate(([0], np.cumsum(t.kind == LITERAL)))
    here = t.counts[doc] + at
    ok = literal[here + width] - literal[here] >= min(LITERALS, width)
    return h[ok], doc[ok], at[ok]


class Index(NamedTuple):
    """Benchmark items: their templates, sorted windows of each width, and the same of their words
    (width, hashes, items; each pair once)."""

    ids: np.ndarray
    items: Templates
    windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    verbatim: list[tuple[int, np.ndarray, np.ndarray]]


def build_index(ids: list[int], items: list[str]) -> Index:
    raw = [x.encode() for x in items]
    t = templates(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    size = np.diff(t.counts)
    windows = []
    for width in range(LITERALS, WINDOW + 1):  # a shorter item is one window of its own length
        h, item, at = _windows(t, width)
        own = size[item] >= WINDOW if width == WINDOW else size[item] == width
        if own.any():
            h, item, at = h[own], item[own], at[own]
            order = np.argsort(h, kind="stable")
            windows.append((width, h[order], item[order], at[order]))
    verbatim, n_words = [], np.diff(t.word_counts)
    for width in range(SHORTEST, RUN + 1):
        h, item = word_windows(t.words, t.word_counts, width)
        own = n_words[item] >= RUN if width == RUN else n_words[item] == width
        if own.any():
            verbatim.append((width, *_pairs(h[own], item[own])))
    return Index(np.array(ids, np.int64), t, windows, verbatim)


def _pairs(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct (hash, text) once, by hash."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def _widest(words: np.ndarray, n: int) -> list[np.ndarray]:
    """Hashes of the windows of 1, 2, 4, ... words, up to ``n``."""
    out = [words]
    while 2 << (len(out) - 1) <= n:
        half, w = out[-1], 1 << (len(out) - 1)
        out.append(mix(half[:-w] * U(STEP) + half[w:]))
    return out


def _shared(doc: np.ndarray, item: np.ndarray, least: int) -> tuple[int, int, int]:
    """(words, start in the document, start in the item) of the longest run of equal
    words, the first of these in the document; one of ``least`` words is there."""
    most = min(len(doc), len(item))
    levels = _widest(doc, most), _widest(item, most)

    def windows(level: list[np.ndarray], n: int) -> np.ndarray:
        k = n.bit_length() - 1
        h, rest = level[k], n - (1 << k)  # two windows that overlap make up one of n words
        return h if rest == 0 else mix(h[:len(h) - rest] * U(STEP) + h[rest:])

    lo, hi = least, most + 1
    while hi - lo > 1:
        n = (lo + hi) // 2
        lo, hi = (n, hi) if np.isin(windows(levels[0], n), windows(levels[1], n)).any() else (lo, n)
    a, b = windows(levels[0], lo), windows(levels[1], lo)
    at = int(np.isin(a, b).argmax())
    return lo, at, int((b == a[at]).argmax())


def _longest(doc: Templates, d0: int, item: Templates, i0: int, n: int) -> tuple[int, int, bool]:
    """(tokens, start, verbatim) of the longest stretch of n matched tokens whose
    placeholders' values map one to one."""
    best, start, there, back, differs = (0, 0, True), 0, {}, {}, -1
    for k in range(n):
        if item.kind[i0 + k] != LITERAL:
            a, b = int(item.value[i0 + k]), int(doc.value[d0 + k])
            # a stretch with this token begins after the last one that is at odds with it
            for seen, x, y in ((there, a, b), (back, b, a)):
                was, at = seen.get(x, (y, -1))
                if was != y:
                    start = max(start, at + 1)
                seen[x] = y, k
            if a != b:
                differs = k
        if k + 1 - start > best[0]:
            best = (k + 1 - start, start, differs < start)
    return best


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold benchmark items, also with other numbers, names or units.

    ``benchmark``: ``item_id``, ``text``.  One row per document row and item:
    ``doc_id``, ``item_id``, ``n_matched`` (template tokens of the longest
    consistent run), ``n_item`` (template tokens of the item), ``start`` (the
    run's first template token in the document) and ``verbatim`` (all its values
    are the item's).  A row is given if the run has at least 10 tokens, or the
    whole item if that is shorter; the run's windows hold five literal words.

    Else a row is given, with ``verbatim``, for a run of at least 10 words (the
    whole item if that is shorter) that are the item's in any script and of any
    kind; ``n_matched`` then counts the item's tokens that the longest such run
    is in.  Characters of scripts without blanks are words.

    Null and empty texts match nothing; nor do items of fewer than four words.  Equal items give a row each; rows with repeated or null ids are
    judged like any other.  No documents or no items give no rows.  Extra columns
    are ignored.
    """
    rows, found = texts(docs), None
    for index in _indexes(docs.sparkSession, benchmark):
        here = rows.mapInArrow(_matcher(index), "doc_id long, item_id long, n_matched int, n_item int, start int, "
                                                "verbatim boolean")
        found = here if found is None else found.unionByName(here)
    return found


def _indexes(spark: SparkSession, benchmark: DataFrame) -> Iterator:
    """The broadcast index of each block of the benchmark."""
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        part.sort(key=lambda r: (r["item_id"], r["text"]))
        yield spark.sparkContext.broadcast(build_index([r["item_id"] for r in part], [r["text"] for r in part]))


def _matches(idx: Index, part: pa.RecordBatch) -> dict[tuple[int, int], tuple[int, int, bool, int]]:
    """(row, item) of the contaminated rows of ``part``: matched tokens, -start, verbatim, the item's tokens."""
    t = templates(*text_buffer(part.column("text")))
    runs: dict[tuple[int, int, int], list[tuple[int, int]]] = defaultdict(list)
    for width, hashes, item, place in idx.windows:
        h, doc, at = _windows(t, width)
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        for k in np.flatnonzero(hi > lo).tolist():
            for j in range(lo[k], hi[k]):  # windows on one diagonal make a run
                runs[int(doc[k]), int(item[j]), int(at[k] - place[j])].append((int(at[k]), width))
    best: dict[tuple[int, int], tuple[int, int, bool, int]] = {}
    for (doc, item, shift), places in runs.items():
        places.sort()
        i, n_item = idx.items.counts[item], int(idx.items.counts[item + 1] - idx.items.counts[item])
        k = 0
        while k < len(places):
            a, b = places[k][0], places[k][0] + places[k][1]
            k += 1
            while k < len(places) and places[k][0] <= b:
                b = max(b, places[k][0] + places[k][1])
                k += 1
            n, start, same = _longest(t, int(t.counts[doc]) + a, idx.items, int(i) + a - shift, b - a)
            if n >= min(RUN, n_item):
                best[doc, item] = max(best.get((doc, item), (0,)), (n, -(a + start), same, n_item))
    words, known = t.word_counts, idx.items.word_counts
    for width, hashes, item in idx.verbatim:
        h, doc = word_windows(t.words, words, width)
        there = np.searchsorted(hashes, h, "right") > np.searchsorted(hashes, h, "left")
        h, doc = _pairs(h[there], doc[there])
        lo, n = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        n -= lo
        at = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
        for d, i in sorted(set(zip(np.repeat(doc, n).tolist(), item[at].tolist())) - best.keys()):
            size, a, b = _shared(t.words[words[d]:words[d + 1]], idx.items.words[known[i]:known[i + 1]], width)
            token = idx.items.token[known[i] + b:known[i] + b + size]
            best[d, i] = (int(token[-1] - token[0]) + 1, -int(t.token[words[d] + a] - t.counts[d]), True,
                          int(idx.items.counts[i + 1] - idx.items.counts[i]))
    return best


def _matcher(index):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_matched", pa.int32()),
                        ("n_item", pa.int32()), ("start", pa.int32()), ("verbatim", pa.bool_())])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx: Index = index.value
        for part in doc_slices(batches, 1 << 20):
            ids = part.column("doc_id")
            out = [(ids[doc].as_py(), int(idx.ids[item]), n, n_item, -start, same)
                   for (doc, item), (n, start, same, n_item) in sorted(_matches(idx, part).items())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return match


def _cleaner(index):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx: Index = index.value
        for part in doc_slices(batches, 1 << 20):
            keep = np.ones(part.num_rows, bool)
            keep[[doc for doc, _ in _matches(idx, part)]] = False
            yield part.filter(pa.array(keep))

    return clean


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which ``find_contamination`` finds an item; others stay as they are.

    Every row is judged by its own text, with repeated or null ids too.
    """
    for index in _indexes(docs.sparkSession, benchmark):
        docs = docs.mapInArrow(_cleaner(index), docs.schema)
    return docs


def op6(spark, sf_dir: str) -> DataFrame:
    """``find_contamination`` of all documents by the whole benchmark."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
