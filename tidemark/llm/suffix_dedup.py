"""Suffix-array dedup: repeated byte strings, by a difference cover, block by block.

Full sorting of all suffixes would move every suffix; here the places of a
difference cover stand for them.  The cover (modulo 91, 10 residues) has, for any
two starts i and j, a shift d < 91 at which both i + d and j + d are cover
places.  So whenever two strings of ``length`` bytes are equal, the cover places
inside them have equal contexts of ``length - 90`` bytes.

1. *Cover sample.*  The context of each cover place gets its rank: since only
   equality of prefixes counts here, the rank is the context's fingerprint, not
   its place in the alphabet.  Sorted bucket by bucket, a rank is repeated or not.
2. *Suffixes, one bucket at a time.*  Only suffixes that start at most 90 bytes
   before a cover place of repeated rank can tie over ``length`` bytes.  They are
   dealt to buckets by the hash of their first ``length`` bytes and sorted there,
   one bucket in memory; equal neighbours are the ties of at least ``length``.
3. Bytes that tied suffixes cover are merged into maximal intervals and removed.

Each step's result is written to the shared folder before the next begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import covered, spans_of, window_hash
from tidemark.llm.common import BUCKET_BYTES, doc_slices, longs, n_buckets, staged, text_buffer, texts
from tidemark.llm.repeats import DEALT, SLICE, Dealer, PlacedDealer, among, repeated, run_places, unpack

#: Perfect difference set: every residue modulo 91 is a difference of two of these.
COVER_MOD, COVER = 91, (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)
#: Bits that a rank has beyond those that number the input's bytes; a chance tie
#: (one in 2**RANK_BITS places) only makes a candidate more.
RANK_BITS = 10
#: Low bits of a string's 64-bit hash that an answer to its document leaves out.
ANSWER_CUT = 16

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def cover_places(n: int) -> np.ndarray:
    """Ascending places below ``n`` whose residue is in the cover."""
    rounds = -(-n // COVER_MOD) if n > 0 else 0
    at = (np.arange(rounds)[:, None] * COVER_MOD + np.array(COVER)).reshape(-1)
    return at[:np.searchsorted(at, n)]


def _sample(data: np.ndarray, offsets: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, document, rank hash) of each cover place with a whole context."""
    lengths = np.diff(offsets)
    longest = cover_places(int(lengths.max(initial=0)) - context + 1)
    counts = np.searchsorted(longest, np.maximum(lengths - context + 1, 0))
    doc = np.repeat(np.arange(len(lengths)), counts)
    at = longest[np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)] + offsets[doc]
    return at, doc, window_hash(data, context, at)


def suffix_dedup(docs: DataFrame, length: int = 200, *keep: str) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else.

    Texts are their UTF-8 bytes; strings never cross documents; the other place
    may be in the same document and may overlap.  Strings are judged on the
    input.  ``length`` must be at least 182, so that contexts are as long as the
    cover's period.

    Returns one row per input row: ``doc_id``, ``n_bytes``, ``spans`` (maximal
    removed runs of bytes, end exclusive), ``kept`` (remaining bytes, binary),
    ``kept_text`` (the same as text, without characters that a cut broke) and the
    columns named in ``keep``.

    Null text counts as empty.  Texts shorter than ``length`` keep all bytes.
    Rows are separate documents even when ids repeat, so equal texts of
    ``length`` bytes or more go; rows with a null ``doc_id`` take no part and
    keep their bytes.  Extra columns are ignored.
    """
    if length < 2 * COVER_MOD:
        raise ValueError(f"length must be at least {2 * COVER_MOD}")
    context = length - COVER_MOD + 1
    rows = texts(docs)
    buckets = n_buckets(rows)
    shift = 64 - min(64, (buckets * 4 * BUCKET_BYTES).bit_length() + RANK_BITS)

    def rank_cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer("any", buckets, shift)
        for part in doc_slices(batches, SLICE):
            data, offsets = text_buffer(part.column("text"))
            _, doc, rank = _sample(data, offsets, context)
            yield from dealer.add(rank, longs(part.column("doc_id"))[doc])
        yield from dealer.flush()

    def deal_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = PlacedDealer(buckets)
        for part in doc_slices(batches, SLICE):
            data, offsets = text_buffer(part.column("text"))
            ids, answers = part.column("doc_id"), part.column("h")
            for i in range(part.num_rows):
                own = data[offsets[i]:offsets[i + 1]]
                if len(own) < length:
                    continue
                at, _, rank = _sample(own, np.array([0, len(own)]), context)
                at = at[among(rank >> np.uint64(shift), unpack(answers[i].as_py()))]
                # from 90 bytes before a cover place of repeated rank to the place itself
                near = covered(np.maximum(at - COVER_MOD + 1, 0), at + 1, len(own))
                starts = np.flatnonzero(near[:len(own) - length + 1])
                h = window_hash(own, length, starts)
                yield from dealer.add_text(ids[i].as_py(), own.tobytes(), h, starts)
        yield from dealer.flush()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, SLICE):
            data, offsets = text_buffer(part.column("text"))
            spans, kept = [], []
            for i, (h, keys, runs) in enumerate(zip(*(part.column(c).to_pylist() for c in ("h", "text_key", "runs")))):
                own, gone = data[offsets[i]:offsets[i + 1]], []
                if h or keys:
                    first, end = run_places(own.tobytes(), keys, runs)
                    tied = np.flatnonzero(among(window_hash(own, length) >> np.uint64(ANSWER_CUT), unpack(h))) if h else first[:0]
                    mask = covered(np.concatenate((tied, first)), np.concatenate((tied, end - 1)) + length, len(own))
                    gone = [{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in spans_of(mask)))]
                    own = own[~mask]
                spans.append(gone)
                kept.append(own.tobytes())
            text = [x.decode("utf-8", "ignore") for x in kept]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, _SPANS), pa.array(kept, pa.binary()),
                 pa.array(text, pa.string()), *(part.column(c) for c in keep)],
                names=["doc_id", "n_bytes", "spans", "kept", "kept_text", *keep])

    known = rows.filter("doc_id IS NOT NULL")
    ranks = repeated(known.mapInArrow(rank_cover, DEALT), "any", buckets).select("doc_id", "h")
    ranks = staged(ranks, "cover-ranks", release=True)
    # texts whose least repeated rank is the same are written one after the other, so that
    # most copies' suffixes are settled in one task; a crowd at one rank is split by size
    near = known.join(ranks, "doc_id").select("doc_id", "text", "h", F.substring("h", 2, 8).alias("least"))
    near = staged(near.hint("rebalance", "least").sortWithinPartitions("least").drop("least"), "suffix-texts", release=True)
    ties = staged(repeated(near.mapInArrow(deal_suffixes, DEALT), "any", buckets, ANSWER_CUT), "ties", release=True)
    whole = texts(docs, *keep)
    judged = whole.join(ties, "doc_id", "left").select("doc_id", "text", "h", "text_key", "runs", *keep)
    kept = "".join(f", `{c}` {whole.schema[c].dataType.simpleString()}" for c in keep)
    return judged.mapInArrow(
        remove, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary, "
                "kept_text string" + kept)


def op9(spark, docs: DataFrame) -> DataFrame:
    """The digest columns of ``suffix_dedup`` over strings of 200 bytes."""
    out = suffix_dedup(docs, 200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
