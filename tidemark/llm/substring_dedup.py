"""Substring dedup: repeated fixed-length token windows, by Rabin-Karp hashes.

Every window of ``width`` words of every text gets a rolling 64-bit hash; Spark
counts the hashes in hash buckets (``repeats``), and the words that repeated
windows cover are merged into maximal intervals and removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import covered, spans_of, word_windows, words
from tidemark.llm.common import doc_slices, longs, n_buckets, staged, text_buffer, texts
from tidemark.llm.repeats import DEALT, SLICE, Dealer, among, repeated, unpack

_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                  ("kept_text", pa.string())])


def substring_dedup(docs: DataFrame, width: int = 13) -> DataFrame:
    """Remove each word covered by a window that also starts in an earlier document.

    Words are runs of bytes other than blank and 0x09-0x0D, unchanged; a window
    is ``width`` consecutive words of one text; "earlier" means a smaller
    ``doc_id``.  Windows are judged on the input, not on what is left.

    Returns one row per input row: ``doc_id``, ``n_words``, ``spans`` (maximal
    removed intervals of word positions, end exclusive) and ``kept_text`` (kept
    words joined by one blank).

    Null text counts as empty: no words, no spans, empty ``kept_text``.  Texts
    shorter than a window keep all words.  Rows that share a ``doc_id`` count as
    one document: their windows never remove each other, and each row is
    returned.  A row with a null ``doc_id`` takes no part and keeps its words.
    Extra columns are ignored.
    """
    rows = texts(docs)
    buckets = n_buckets(rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer("earlier", buckets)
        for part in doc_slices(batches, SLICE):
            data, offsets = text_buffer(part.column("text"))
            h, doc = word_windows(*words(data, offsets), width)
            yield from dealer.add(h, longs(part.column("doc_id"))[doc])
        yield from dealer.flush()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, SLICE):
            data, offsets = text_buffer(part.column("text"))
            hashes, counts = words(data, offsets)
            body = data.tobytes()
            spans, kept = [], []
            for i, answers in enumerate(part.column("h").to_pylist()):
                tokens = body[offsets[i]:offsets[i + 1]].split()
                gone = []
                if answers:
                    h, _ = word_windows(hashes[counts[i]:counts[i + 1]], np.array([0, len(tokens)]), width)
                    starts = np.flatnonzero(among(h, unpack(answers)))
                    mask = covered(starts, starts + width, len(tokens))
                    gone = [{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in spans_of(mask)))]
                    tokens = compress(tokens, (~mask).tolist())
                spans.append(gone)
                kept.append(b" ".join(tokens))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(counts)), pa.array(spans, _OUT.field("spans").type),
                 pa.array(kept, pa.binary()).cast(pa.string())], schema=_OUT)

    found = repeated(rows.filter("doc_id IS NOT NULL").mapInArrow(deal, DEALT), "earlier", buckets)
    found = staged(found.select("doc_id", "h"), "repeated-windows", release=True)
    return rows.join(found, "doc_id", "left").select("doc_id", "text", "h").mapInArrow(
        remove, "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept_text string")


def op8(spark, docs: DataFrame) -> DataFrame:
    """The digest columns of ``substring_dedup`` over 13-word windows."""
    out = substring_dedup(docs, 13)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))
