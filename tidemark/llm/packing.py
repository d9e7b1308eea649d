"""Best-fit packing of tokenized documents into sequences of fixed length.

Bulk-synchronous best fit, largest pieces first.  Sizes are whole numbers up to
the capacity, so the range-sorted pieces and gaps are runs: all pieces of one
size, all sequences with one gap.  Ranks within a run are made where the pieces
are (task counts and their running sums); a round sweeps a run of pieces over the
runs of gaps, from its successor (the least gap that holds the size) upwards,
gives the k-th piece to the k-th gap, splits both runs where one ends, and
updates the gaps.  What meets on the driver are the runs, whose number depends on
the capacity alone; every piece then looks up its place by size and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder
from tidemark.llm.common import doc_slices, staged, texts

SLICE = 2 << 20
_PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
          ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its table serves all the worker's tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """Token pieces of each document, with the task and the number within the
    task's pieces of that length (written out, so that both stay as they are)."""
    schema = pa.schema(_PIECE + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for part in doc_slices(batches, SLICE):
            ids, at = encoder.encode(part.column("text").to_pylist())
            rows = []
            for i, doc in enumerate(part.column("doc_id").to_pylist()):
                own = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")
                n = len(own)
                first = n % capacity or capacity
                cuts = [0, n] if n <= capacity else [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(own[a:b].tobytes()), task, seen[b - a]))
                    if with_ids:
                        rows[-1] += (own[a:b].astype(np.int32),)
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    more = ", ids array<int>" if with_ids else ""
    return staged(docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                       "task int, nth long" + more), "pieces")


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rules (length, first rank, end rank, first sequence, pieces per sequence, offset).

    ``counts``: pieces of each length.  Pieces of a rule go to consecutive
    sequences, ``per`` to each, from ``offset`` on.
    """
    rules, gaps, runs, opened = [], [], defaultdict(list), 0

    def close(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(k)
            else:
                gap = capacity
                first, n = opened, -(-left // (capacity // length))
                opened += n
            per = gap // length
            whole = min(n, left // per)
            rest = min(left - whole * per, per - 1) if whole < n else 0
            for seqs, each, at in ((whole, per, first), (1 if rest else 0, rest, first + whole)):
                if seqs:
                    rules.append((length, rank, rank + seqs * each, at, each, capacity - gap))
                    rank, left = rank + seqs * each, left - seqs * each
                    close(gap - each * length, at, seqs)
            used = whole + (1 if rest else 0)
            close(gap, first + used, n - used)
    return rules


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
                   with_ids: bool = True) -> DataFrame:
    """Tokenize documents and pack them into few sequences of ``capacity`` tokens.

    A document is its token ids by the ``tokenizers`` file at ``path`` without
    special tokens, then ``end_id``.  Only documents longer than ``capacity``
    are cut, into pieces of ``capacity`` tokens of which the first may be
    shorter.  Returns one row per piece: ``doc_id``, ``piece``, ``start`` (the
    document's ids before it), ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, with ``with_ids``, the token ids.

    Null text counts as empty and is one piece with ``end_id`` alone.  Every row
    is a document, with repeated or null ``doc_id`` too.  No rows give no rows.
    Extra columns are ignored.
    """
    cut = pieces(texts(docs), path, capacity, end_id, with_ids)
    dealt = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = dealt.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules = docs.sparkSession.createDataFrame(
        best_fit_runs(counts, capacity), "length long, lo long, hi long, first long, per long, at long")
    placed = (cut.join(ranks, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
              .join(F.broadcast(rules), "length").filter("rank >= lo AND rank < hi"))
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("per"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("per") * F.col("length")).alias("offset"), *(["ids"] if with_ids else []))


def op2(spark, docs: DataFrame) -> DataFrame:
    """``pack_documents`` into 1,024 tokens with the public byte-level BPE of 50k ids."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2, with_ids=False)
