"""Document fingerprints from closed syncmers.

A k-mer (here of bytes) is a closed syncmer if its least inner s-mer, by hash,
stands at its first or last place.  Whether it is one depends on the k-mer alone,
not on what stands around it, so the same passage gives the same anchors in any
document, and equal anchors can be matched by their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import mix
from tidemark.llm.common import doc_slices, n_buckets, texts

U = np.uint64
#: Bytes of an anchor and of its inner strings, and anchors that a fingerprint keeps at least.
K, S, ANCHORS = 16, 8, 64
#: An anchor's hash has 40 bits; every one below ``BOUND`` (one of 16) is kept.
SHIFT = U(24)
BOUND = 1 << 36
#: Places by which neighbours among the matched anchors may differ in their shift.
SLACK = 64
#: Ranges of ids at most, so that their ends stay a small list.
MAX_RANGES = 1 << 14

_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])


def syncmers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of every closed syncmer of a text; a text shorter than one
    k-mer is one anchor, an empty text has none."""
    n = len(data) - K + 1
    if n <= 0:
        whole = np.zeros(K, np.uint8)
        whole[:len(data)] = data
        h = mix(mix(whole.view(np.uint64)) * U(31) + U(len(data)))
        h = mix(h[:1] * U(7) + h[1:]) if len(data) else np.zeros(0, np.uint64)
        return h >> SHIFT, np.zeros(len(h), np.int64)
    inner = mix(np.lib.stride_tricks.sliding_window_view(data, S).copy().view(np.uint64).reshape(-1))
    width, least, span = K - S + 1, inner, 1
    while span < width:  # sliding minimum by doubling
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    at = np.flatnonzero((least == inner[:n]) | (least == inner[K - S:]))
    return mix(inner[at] * U(0x9E3779B97F4A7C15) + inner[at + K - S]) >> SHIFT, at


def sketch(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct syncmers of a hash below BOUND, or the ANCHORS of least hash if these are
    more: ascending hashes, and the first place of each.

    The bound is the same for all texts, so the number of anchors follows the text's length
    and a passage has the same share of them in a text of any length.
    """
    h, at = syncmers(data)
    low = h < U(BOUND)
    if low.sum() >= 2 * ANCHORS:  # then the bound decides, unless most are copies
        x, first = np.unique(h[low], return_index=True)
        if len(x) >= ANCHORS:
            return x, at[low][first]
    x, first = np.unique(h, return_index=True)
    n = max(ANCHORS, int(np.searchsorted(x, U(BOUND))))
    return x[:n], at[first[:n]]


def known_below(hashes: np.ndarray) -> int:
    """All of a text's anchors with a hash below this are in its fingerprint."""
    if len(hashes) < ANCHORS:
        return 1 << 40
    return max(BOUND, int(hashes[-1]) + 1)


def to_text(anchors: tuple[np.ndarray, np.ndarray]) -> str:
    """``hash@place`` of each anchor in the text's order, in hexadecimal."""
    h, at = anchors
    order = np.argsort(at, kind="stable")
    return " ".join(f"{x:010x}@{p:x}" for x, p in zip(h[order].tolist(), at[order].tolist()))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of anchors in common (Dice) among the hashes that both fingerprints know.

    Equal hashes match by place too: taken in the order of the first text, a match counts
    if the one before or after it has about the same shift, or if there are at most two.
    So passages may have moved by any distance, and each is judged by what stands around
    it.  Two fingerprints without anchors are alike (1).
    """
    (x, p), (y, q) = a, b
    if not len(x) and not len(y):
        return 1.0
    least = U(min(known_below(x), known_below(y)))
    x, y = x[x < least], y[y < least]
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    n = len(i)
    if n > 2:
        order = np.argsort(p[i])
        near = np.abs(np.diff((p[i] - q[j])[order])) <= SLACK
        n = int((np.append(near, False) | np.insert(near, 0, False)).sum())
    return round(2 * n / (len(x) + len(y)), 6)


def to_ranges(rows: DataFrame) -> DataFrame:
    """Deal rows to ranges of ``doc_id``: ``doc_id``, ``text``, ``part``, ``extra``.

    Ranges end at ids that are quantiles.  The row at a range's greatest id also
    goes, as ``extra``, to the range above, whose last row it follows in
    descending order; the greatest of all goes to the lowest range.  So every
    row meets its successor in its own range, and texts move once.  Rows without an
    id meet no other and are spread over parts below 0.
    """
    ranges = min(n_buckets(rows), MAX_RANGES)
    known = rows.filter("doc_id IS NOT NULL").select("doc_id")
    cuts = known.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5],
                                         max(10_000, 20 * ranges)).alias("cuts"), F.max("doc_id").alias("top")).first()
    ends = np.unique(np.array([*(cuts["cuts"] or []), cuts["top"] or 0], np.int64))

    @F.pandas_udf("array<struct<part: int, extra: boolean>>")
    def places(ids: pd.Series) -> pd.Series:
        part = np.minimum(np.searchsorted(ends, ids.to_numpy()), len(ends) - 1)
        ends_here = ends[part] == ids.to_numpy()
        above = (part + 1) % len(ends)
        return pd.Series([[(p, False), (q, True)] if e else [(p, False)]
                          for p, q, e in zip(part.tolist(), above.tolist(), ends_here.tolist())])

    spread = (F.lit(-1) - F.pmod(F.xxhash64("text"), F.lit(len(ends)))).cast("int")
    alone = F.array(F.struct(spread.alias("part"), F.lit(False).alias("extra")))
    at = rows.filter("doc_id IS NOT NULL").withColumn("to", F.explode(places("doc_id"))).unionByName(
        rows.filter("doc_id IS NULL").withColumn("to", F.explode(alone)))
    return (at.select("doc_id", "text", "to.part", "to.extra").repartition(len(ends), "part")
            .sortWithinPartitions("part", "extra", F.desc("doc_id"), F.xxhash64("text")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Documents are taken in descending order of ``doc_id`` (rows that share an id
    in the order of their text's hash); after the last comes the first.  The
    edited text has its last floor(n / 2) code points replaced by the first as
    many (or all) of the next document's.

    Returns one row per input row: ``doc_id``, ``n_chars`` (code points),
    ``edited_text``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (likeness to the edited text and to the next document).  Null
    text counts as empty: an empty fingerprint, alike only to another one.  The
    only row of a table is its own next.  A row with a null ``doc_id`` has no
    place in the order: its next text counts as empty.  Extra columns are ignored.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def close(row: tuple, text: str, anchors: tuple) -> None:
            doc, own_text, own = row
            n = len(own_text)
            edited = own_text[:n - n // 2] + text[:n // 2]
            changed = sketch(np.frombuffer(edited.encode(), np.uint8))
            out.append((doc, n, edited, to_text(own), to_text(changed), likeness(own, changed), likeness(own, anchors)))

        def batch() -> pa.RecordBatch:
            rows = [pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)]
            out.clear()
            return pa.RecordBatch.from_arrays(rows, schema=_OUT)

        last, at = None, None  # the row that waits for its next, and its range
        for part in doc_slices(batches, 1 << 20):
            for doc, text, where, extra in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "part", "extra"))):
                anchors = sketch(np.frombuffer(text.encode(), np.uint8))
                if last is not None and (where != at or where < 0):
                    close(last, "", sketch(np.zeros(0, np.uint8)))  # only rows without a place end like this
                    last = None
                if last is not None:
                    close(last, text, anchors)
                last, at = (None if extra else (doc, text, anchors)), where
            if out:
                yield batch()
        if last is not None:
            close(last, "", sketch(np.zeros(0, np.uint8)))
            yield batch()

    return to_ranges(texts(docs)).mapInArrow(
        compare, "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")


def op3(spark, docs: DataFrame) -> DataFrame:
    """``fingerprints`` of all documents, the edited text as its digest."""
    out = fingerprints(docs)
    return out.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next")
