"""Token ids of a corpus in binary files: frequency-ranked, byte-aligned, read back by table lookup.

Ids are replaced by their rank by frequency in the whole corpus, so that most take
one byte.  Ranks are coded four at a time: a control byte holds the four lengths
(1 to 4 bytes, two bits each), the values' bytes stand apart from the control bytes.
A control byte thus names the places of its four values' bytes, and the decoder is
a lookup of these places and one gather, in numpy.

A folder of token files holds ``ids/part-*``, whose names and contents follow
ascending ``doc_id``, and ``ranks`` (Parquet: rank, id, occurrences).  Files are
written and committed by Spark's text writer, one row of raw bytes for each block,
and read by its binary reader, so any file system that Spark reaches will do.

    block   = HEADER, null mask, doc_id of each document, ids of each document, control bytes, data bytes, 0x0A
    HEADER  = magic, version, documents, ids, first id's number in the corpus, data bytes
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder
from tidemark.llm.common import doc_slices, longs, n_buckets, stage_root, staged, texts

MAGIC, VERSION = b"TIDS", 1
HEADER = struct.Struct("<4sIQQQQ")
#: Text bytes of one file, and of the slices that are tokenized at a time.
FILE_BYTES, SLICE = 64 << 20, 2 << 20
#: Ids of one block (a longer document is a block of its own), and ids decoded at a time.
BLOCK_IDS, CHUNK = 1 << 21, 1 << 20
#: What a document without text counts for when files are filled.
ROW_BYTES = 16
_NO_ID = -(1 << 63)

_encoders: dict[str, Encoder] = {}

# ---------------------------------------------------------------- the coding

_lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: Bytes of the four values of a control byte; where each value's four bytes stand (16: none).
TOTAL = _lengths.sum(1)
_first = np.cumsum(_lengths, 1) - _lengths
PLACES = np.where(np.arange(4) < _lengths[:, :, None], _first[:, :, None] + np.arange(4), 16).reshape(256, 16)


def encode_ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[:len(v)] = more
    return (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8), data


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values behind control and data bytes."""
    out = np.empty((len(control), 16), np.uint8)
    at = 0
    for lo in range(0, len(control), CHUNK // 4):
        c = control[lo:lo + CHUNK // 4]
        size = TOTAL[c]
        ends = np.cumsum(size)
        own = np.zeros(int(ends[-1]) + 16, np.uint8)  # the last byte stands for the bytes that a value lacks
        part = data[at:at + int(ends[-1])]
        own[:len(part)] = part
        places = PLACES[c]
        places = np.where(places == 16, len(own) - 1, places + (ends - size)[:, None])
        out[lo:lo + len(c)] = own[places]
        at += int(ends[-1])
    return out.reshape(-1, 4).view("<u4").reshape(-1)[:n]


def block_bytes(doc_ids: pa.Array, counts: np.ndarray, ranks: np.ndarray, start: int) -> bytes:
    """A block of the documents' ranks; ``start``: ids of the corpus before the first."""
    control, data = encode_ranks(ranks)
    null = doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    return b"".join((HEADER.pack(MAGIC, VERSION, len(counts), len(ranks), start, len(data)), null.tobytes(),
                     doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(), counts.astype("<u8").tobytes(),
                     control.tobytes(), data.tobytes()))


def read_blocks(content: bytes) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int]]:
    """(doc_ids, counts, ranks, start) of each block of a file."""
    at, whole = 0, memoryview(content)

    def take(dtype: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(whole, dtype, n, at)
        at += out.nbytes
        return out

    while at < len(whole):
        magic, version, docs, ids, start, data = HEADER.unpack_from(whole, at)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token file of this version")
        at += HEADER.size
        null, doc_ids, counts = take("u1", docs), take("<i8", docs), take("<u8", docs).astype(np.int64)
        control = take("u1", -(-ids // 4))
        ranks = decode_ranks(control, take("u1", data), ids)
        if whole[at] != 0x0A:
            raise ValueError("a block of a token file is cut short")
        at += 1
        yield pa.array(doc_ids, pa.int64(), mask=null.astype(bool)), counts, ranks, start


# ---------------------------------------------------------------- writing

_KEYS = ("doc_id", "tie", "row")


def _file_starts(keys: DataFrame, file_bytes: int, parts: int) -> list[tuple[int, int, int]]:
    """Least key of each file but the first.

    Keys alone are range-sorted; a task begins a file after every ``file_bytes`` of text.
    One row for each file comes to the driver.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, last = 0, -1
        for b in batches:
            size = longs(b.column("size"))
            ends = filled + np.cumsum(size)
            piece = (ends - size) // file_bytes
            begin = np.diff(piece, prepend=last) > 0
            if len(ends):
                filled, last = int(ends[-1]), int(piece[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(longs(b.column(k))[begin], pa.int64()) for k in _KEYS], names=list(_KEYS))

    sorted_keys = keys.repartitionByRange(parts, *_KEYS).sortWithinPartitions(*_KEYS)
    rows = sorted_keys.mapInArrow(cut, "doc_id long, tie long, row long").collect()
    return sorted((r["doc_id"], r["tie"], r["row"]) for r in rows)[1:]


def _file_of(starts: list[tuple[int, int, int]], heads: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    """Number of the file of each row."""
    doc, tie, row = (longs(batch.column(k)) for k in _KEYS)
    lo, hi = np.searchsorted(heads, doc, "left"), np.searchsorted(heads, doc, "right")
    for i in np.flatnonzero(hi > lo).tolist():  # a file begins among the rows of this doc_id
        hi[i] = bisect_right(starts, (int(doc[i]), int(tie[i]), int(row[i])), int(lo[i]), int(hi[i]))
    return hi.astype(np.int32)


def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its table serves all the worker's tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokenized(docs: DataFrame, path: str, end_id: int, width: str, starts: list[tuple[int, int, int]]) -> DataFrame:
    """Ids of each document (as bytes of ``width``), their number and the file they go to."""
    heads = np.array([s[0] for s in starts], np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for part in doc_slices(batches, SLICE):
            ids, at = encoder.encode(part.column("text").to_pylist())
            ids = np.insert(ids, at[1:], end_id).astype(width)
            at = at + np.arange(len(at))
            size = np.dtype(width).itemsize
            blobs = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                          [None, pa.py_buffer(at * size), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in _KEYS), part.column("no_id"), pa.array(_file_of(starts, heads, part)),
                 pa.array(np.diff(at)), blobs.cast(pa.binary())],
                names=[*_KEYS, "no_id", "file", "n", "ids"])

    return docs.mapInArrow(encode, "doc_id long, tie long, row long, no_id boolean, file int, n long, ids binary")


def _frequencies(rows: DataFrame, width: str, size: int) -> DataFrame:
    """Occurrences of each id: one partial count per task, summed up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for blob in b.column("ids"):
                total += np.bincount(np.frombuffer(blob.as_buffer(), width), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    return rows.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _first_ids(rows: DataFrame) -> dict[int, int]:
    """Ids of the corpus before each file (one row per file)."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n").alias("n"))
    start = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    return {r["file"]: r["start"] for r in files.select("file", start).collect()}


def write_token_ids(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, file_bytes: int = FILE_BYTES) -> None:
    """Encode each text by the ``tokenizers`` file at ``tokenizer`` (no special tokens added),
    append ``end_id`` and write all ids in ascending ``doc_id`` order below ``out``.

    Null text counts as empty: ``end_id`` alone.  Every row is a document, with
    repeated ``doc_id`` too (these follow the hash of their text); documents
    without ``doc_id`` come first.  Extra columns are ignored; no rows give files
    without documents.  A file takes about ``file_bytes`` of text; a document is
    in one file, whatever its length.  What comes to the driver is a row for each
    file and one for each id of the vocabulary.
    """
    spark = docs.sparkSession
    encoder = _encoder(tokenizer)
    size = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    own = texts(docs).select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").isNull().alias("no_id"), "text")
    keys = own.select(*_KEYS, (F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("size"))
    starts = _file_starts(keys, file_bytes, n_buckets(docs))
    rows = staged(_tokenized(own, tokenizer, end_id, width, starts), "token-ids")

    ranked = _frequencies(rows, width, size).orderBy(F.desc("n"), "id").collect()
    rank_of = np.zeros(size, np.uint32)
    rank_of[[r["id"] for r in ranked]] = np.arange(len(ranked))
    spark.createDataFrame([(k, r["id"], r["n"]) for k, r in enumerate(ranked)], "rank int, id int, n long") \
        .coalesce(1).write.parquet(f"{out}/ranks")
    first = _first_ids(rows)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, at, held, held_ids = -1, 0, [], 0

        def closed() -> pa.RecordBatch:
            nonlocal at, held, held_ids
            doc_ids = pa.array([h[0] for h in held], pa.int64())
            ranks = rank_of[np.concatenate([h[1] for h in held])]
            block = block_bytes(doc_ids, np.array([len(h[1]) for h in held]), ranks, at)
            at, held, held_ids = at + held_ids, [], 0
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for b in batches:
            files, blobs = b.column("file").to_pylist(), b.column("ids")
            for i, (doc, no_id) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("no_id").to_pylist())):
                ids = np.frombuffer(blobs[i].as_buffer(), width)
                if held and (files[i] != file or held_ids + len(ids) > BLOCK_IDS):
                    yield closed()
                if files[i] != file:
                    file, at = files[i], first[files[i]]
                held.append((None if no_id else doc, ids))
                held_ids += len(ids)
        if held:
            yield closed()

    dealt = rows.repartitionById(len(starts) + 1, "file").sortWithinPartitions("file", *_KEYS)
    dealt.mapInArrow(blocks, "block binary").selectExpr("CAST(block AS STRING) AS value").write.text(f"{out}/ids")


# ---------------------------------------------------------------- reading

def read_token_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the token files below ``path``: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32`` (unsigned, of the ids as little-endian
    unsigned 32-bit integers) and, with ``with_ids``, the ids.  A task holds the
    files that Spark gives it (at most ``spark.sql.files.maxPartitionBytes`` or one file)."""
    rows = spark.read.parquet(f"{path}/ranks").select("rank", "id").collect()  # one row per id of the vocabulary
    id_of = np.zeros(len(rows), "<u4")
    id_of[[r["rank"] for r in rows]] = [r["id"] for r in rows]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                for doc_ids, counts, ranks, start in read_blocks(content.as_buffer()):
                    ids = id_of[ranks]
                    at = np.concatenate(([0], np.cumsum(counts)))
                    view = memoryview(ids).cast("B")
                    crc = [zlib.crc32(view[4 * a:4 * e]) for a, e in pairwise(at.tolist())]
                    cols = [doc_ids, pa.array(start + at[:-1]), pa.array(counts), pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view("<i4"))))
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids").select("content")
    return files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long"
                            + (", ids array<int>" if with_ids else ""))


def op11(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``documents`` written with the public byte-level BPE of 50k ids and read back from the files."""
    import public_tokenizers

    out = f"{stage_root(spark)}/token-files-{uuid.uuid4().hex[:12]}"
    write_token_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), out)
    return read_token_ids(spark, out, with_ids=False)
