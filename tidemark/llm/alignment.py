"""Which tokens of two tokenizers cover the same bytes, and how often each pair is linked.

Texts go through an Arrow pipeline in slices of about ``SLICE`` bytes.  Token ids of
both sides are list columns, flattened with their parent indices; running sums of
token bytes, less what stands before the token's document, are the byte places where
tokens end.  A hash join (full outer) of the two sides on these document ends puts
the ends in one table.  An end of both sides closes a group; between two neighbouring
ends lies one token of each side, so every end is one link.  ``Table.group_by`` counts
the slice's id pairs, and Spark adds the slices' counts up.

Slices are written out with their links as numbers of the slice's own pairs.  The
corpus' counts then come back to the slices by a join on the pair (a row for each
slice and pair, not for each link) and are summed up for each document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder, byte_signs
from tidemark.llm.common import doc_slices, staged, texts

SLICE = 2 << 20
#: Words whose pieces a worker remembers.
REMEMBER = 400_000
SPACE = "▁"  # fixed: the sign that stands for a blank in pieces

_sides: dict[tuple[str, str], tuple] = {}


class ByteSide:
    """Ids by a byte-level file of ``tokenizers``; special tokens in texts are plain text."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.special = []
        signs = byte_signs()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        pieces = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in signs for c in token):
                pieces[i] = bytes(signs[c] for c in token)
        self.pieces = pa.array(pieces, pa.large_binary())

    def encode(self, texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode([f" {t}" for t in texts_])


class PieceSide:
    """Ids by a ``sentencepiece`` model, which puts a blank before the text itself.

    If blanks are only at the beginning of pieces, no merge crosses from a word to
    the blanks after it: each word with the blanks before it has its own ids
    wherever it stands.  Words are then encoded once each and looked up; else
    whole texts are encoded.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_file=path)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.pieces = pa.array([bytes([int(p[1:-1], 16)]) if m.is_byte(i) else p.replace(SPACE, " ").encode()
                                for i, p in enumerate(names)], pa.large_binary())
        kept = "".join(m.encode("  a  b ", out_type=str)) == SPACE * 3 + "a" + SPACE * 2 + "b" + SPACE
        self.by_word = kept and not any(SPACE in p.lstrip(SPACE) for p in names) and m.piece_to_id(SPACE) != m.unk_id()
        self.known: dict[str, list[int]] = {" ": [m.piece_to_id(SPACE)]}

    def encode(self, texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            return _flat(self.model.encode(texts_, num_threads=1))
        rows = [f" {t}".encode() for t in texts_]
        doc_at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))))
        data = np.frombuffer(b"".join(rows), np.uint8)
        blank = data == 0x20
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[doc_at[:-1]] = True
        word_at = np.append(np.flatnonzero(begin), len(data))
        words = pa.Array.from_buffers(pa.large_string(), len(word_at) - 1,
                                      [None, pa.py_buffer(word_at.astype(np.int64)), pa.py_buffer(data)])
        words = words.dictionary_encode()
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > REMEMBER:
            self.known = {w: self.known[w] for w in distinct if w in self.known} | {" ": self.known[" "]}
        self.known.update(zip(new, self.model.encode([w[1:] for w in new], num_threads=1)))
        ids, at = _flat([self.known[w] for w in distinct])
        lists = pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids)).take(words.indices)
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
        return lists.flatten().to_numpy(), ends[np.searchsorted(word_at, doc_at)]


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(at[-1])), at


def _both(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    """One of each per Python worker."""
    if (path_a, path_b) not in _sides:
        _sides[path_a, path_b] = ByteSide(path_a), PieceSide(path_b)
    return _sides[path_a, path_b]


def _rows_of(ids: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the rows kept (the others are empty), and the new row borders."""
    n = np.where(keep, np.diff(at), 0)
    return ids[np.repeat(keep, np.diff(at))], np.concatenate(([0], np.cumsum(n)))


def _byte_counts(pieces: pa.Array, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes of each row's joined tokens."""
    size = pc.binary_length(pieces).to_numpy()[ids]
    return np.diff(np.concatenate(([0], np.cumsum(size)))[at])


def _equal_rows(pieces: pa.Array, ids: np.ndarray, at: np.ndarray, want: bytes, ends: np.ndarray) -> np.ndarray:
    """Rows whose joined tokens are the bytes of ``want`` up to their end there."""
    ok = _byte_counts(pieces, ids, at) == np.diff(ends)
    kept, _ = _rows_of(ids, at, ok)  # rows of other lengths are out before bytes are compared
    body = memoryview(pieces.take(pa.array(kept)).buffers()[2] or b"").cast("B")
    place = np.concatenate(([0], np.cumsum(np.where(ok, np.diff(ends), 0))))
    if ok.all() and body[:place[-1]] == want:
        return ok
    return np.array([o and body[p:q] == want[x:y] for o, (p, q), (x, y)
                     in zip(ok.tolist(), pairwise(place.tolist()), pairwise(ends.tolist()))], bool)


def _ends(ids: np.ndarray, at: np.ndarray, pieces: pa.Array, doc_start: np.ndarray) -> pa.Table:
    """Table of a side's tokens: document, id and the place where the token ends.

    The place is the running sum of bytes within the document (a segmented sum: the
    total less the total before the document), moved to the document's own range.
    """
    lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(ids.astype(np.int64)))
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    size = pc.binary_length(pieces).take(flat)
    total = pc.cumulative_sum(pc.cast(size, pa.int64()))
    before = np.concatenate(([0], total.to_numpy()))[at[:-1]]
    within = pc.subtract(total, pa.array(before).take(parent))
    return pa.table({"end": pc.add(within, pa.array(doc_start).take(parent)), "id": flat, "doc": parent})


def _group_texts(a: np.ndarray, b: np.ndarray, a_closes: np.ndarray, b_closes: np.ndarray, names: pa.Array,
                 n_ids: int) -> tuple[memoryview, np.ndarray, np.ndarray]:
    """``a1,a2|b1;`` of all groups in a row, and the places after each token of a and of b.

    ``names``: each id with ``,``, then each with ``|``, then each with ``;``.
    """
    a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
    groups = int(a_closes.sum())
    a_before = np.concatenate(([0], np.cumsum(np.bincount(a_group, minlength=groups))))
    b_before = np.concatenate(([0], np.cumsum(np.bincount(b_group, minlength=groups))))
    a_place = np.arange(len(a)) + b_before[a_group]
    b_place = np.arange(len(b)) + a_before[b_group + 1]
    codes = np.empty(len(a) + len(b), np.int64)
    codes[a_place] = a + a_closes * n_ids
    codes[b_place] = b + b_closes * 2 * n_ids
    out = names.take(pa.array(codes))
    offsets = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1)
    return memoryview(out.buffers()[2] or b""), offsets, b_place


def _names(n_ids: int) -> pa.Array:
    return pa.array([f"{i}{sign}" for sign in ",|;" for i in range(n_ids)], pa.large_string())


class Slice:
    """Alignment of one slice of texts."""

    def __init__(self, texts_: list[str], a: ByteSide, b: PieceSide, names: pa.Array):
        n_ids = len(names) // 3
        full = [i for i, t in enumerate(texts_) if t]
        want = [f" {texts_[i]}".encode() for i in full]
        ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, want), np.int64, len(want)))))
        joined = b"".join(want)
        (a_ids, a_at), (b_ids, b_at) = (side.encode([texts_[i] for i in full]) for side in (a, b))
        ok = _equal_rows(a.pieces, a_ids, a_at, joined, ends) & _equal_rows(b.pieces, b_ids, b_at, joined, ends)
        (a_ids, a_at), (b_ids, b_at) = _rows_of(a_ids, a_at, ok), _rows_of(b_ids, b_at, ok)
        n, docs = len(texts_), np.array(full, np.int64)

        left = _ends(a_ids, a_at, a.pieces, ends[:-1])
        right = _ends(b_ids, b_at, b.pieces, ends[:-1])
        union = left.join(right, "end", join_type="full outer", right_suffix="_b", use_threads=False).sort_by("end")
        has_a, has_b = (union.column(c).is_valid().combine_chunks().to_numpy(zero_copy_only=False) for c in ("id", "id_b"))
        common = has_a & has_b
        # the token of the other side goes on to the next end of its own
        link_a, link_b, doc = (pc.fill_null_backward(union.column(c)).combine_chunks().to_numpy(zero_copy_only=False)
                               for c in ("id", "id_b", "doc"))
        doc = doc.astype(np.int64)

        def per_doc(counts: np.ndarray) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[docs] = counts
            return out

        self.n_a, self.n_b = per_doc(np.diff(a_at)), per_doc(np.diff(b_at))
        self.n_groups = per_doc(np.bincount(doc[common], minlength=len(full)))
        self.n_links = per_doc(np.bincount(doc, minlength=len(full)))

        pairs = pa.table({"a": link_a, "b": link_b})
        counts = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        counts = counts.sort_by([("count_all", "descending")])  # frequent pairs get small numbers
        self.a, self.b = (counts.column(c).to_numpy().astype(np.int32) for c in "ab")
        self.n = counts.column("count_all").to_numpy()
        key = pa.array(self.a.astype(np.int64) << 32 | self.b)
        links = pc.index_in(pa.array(link_a << 32 | link_b), value_set=key).to_numpy()
        self.links = links.astype("<u2" if len(key) <= 1 << 16 else "<u4").tobytes()

        text, offsets, b_place = _group_texts(a_ids.astype(np.int64), b_ids.astype(np.int64), common[has_a],
                                              common[has_b], names, n_ids)
        after = offsets[np.concatenate(([-1], b_place))[b_at] + 1]  # a document's text ends with its last b
        self.sha = [""] * n
        for i, (p, q) in zip(full, pairwise(after.tolist())):
            if q > p:
                self.sha[i] = hashlib.sha256(text[p:q - 1]).hexdigest()


_SLICE = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, links binary, a array<int>, b array<int>, n array<long>")
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string")


def align_slices(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Slices of the documents with their alignments and their pairs' counts (written out)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _both(path_a, path_b)
        names = _names(max(len(a.pieces), len(b.pieces)))
        first = TaskContext.get().partitionId() << 36
        for k, part in enumerate(doc_slices(batches, SLICE)):
            s = Slice(part.column("text").to_pylist(), a, b, names)
            cols = {"slice": pa.array([first + k]), "doc_id": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64()))}
            for c in ("n_a", "n_b", "n_groups", "n_links", "a", "b", "n"):
                values = getattr(s, c)
                cols[c] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
            cols |= {"groups_sha256": pa.array([s.sha], pa.list_(pa.string())), "links": pa.array([s.links], pa.binary())}
            order = [c.split()[0] for c in _SLICE.split(", ")]
            yield pa.RecordBatch.from_arrays([cols[c] for c in order], names=order)

    return staged(docs.mapInArrow(align, _SLICE), "aligned")


def pair_counts(slices: DataFrame) -> DataFrame:
    """Links of each id pair in the corpus, and whether they are the most of its id b."""
    pairs = slices.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return total.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _answer(slices: pa.Table, found: pa.Table) -> pa.Table:
    """Rows of one slice's documents, with the corpus' counts of their links."""
    row = slices.slice(0, 1).to_pylist()[0]
    count, best = np.zeros(len(found) + 1, np.int64), np.zeros(len(found) + 1, np.int64)
    at = found.column("code").to_numpy()
    count[at], best[at] = found.column("count").to_numpy(), found.column("best").to_numpy()
    links = np.frombuffer(row["links"], "<u2" if len(found) <= 1 << 16 else "<u4")
    ends = np.concatenate(([0], np.cumsum(row["n_links"])))
    n_best, count_sum = (np.diff(np.concatenate(([0], np.cumsum(x[links])))[ends]) for x in (best, count))
    cols = {c: pa.array(row[c], pa.string() if c == "groups_sha256" else pa.int64())
            for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    cols |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.table({c.split()[0]: cols[c.split()[0]] for c in _OUT.split(", ")})


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment of each text's tokens by the byte-level file ``path_a`` (of a blank and the
    text) and the ``sentencepiece`` model ``path_b`` (which adds the blank).

    One row per document: ``n_a``, ``n_b`` tokens; ``n_groups``, between byte places where
    tokens of both end; ``n_links``, pairs of tokens whose bytes overlap; ``n_best``, links
    whose id pair has the most links that its id b has in the corpus (ties count);
    ``count_sum``, the corpus' links of each link's id pair, summed up; ``groups_sha256``.

    Null and empty texts, and texts whose joined tokens are not a blank and the text
    (those that hold U+2581), have no tokens: zeros and an empty digest.  Every row is a
    document, with repeated or null ``doc_id`` too.  Extra columns are ignored; no rows give
    no rows.  A text is aligned whole in one task, whatever its length.
    """
    slices = align_slices(texts(docs), path_a, path_b)
    counts = pair_counts(slices)
    own = slices.select("slice", F.posexplode(F.arrays_zip("a", "b")).alias("code", "p")).select("slice", "code", "p.*")
    found = own.join(counts, ["a", "b"]).select(F.col("slice").alias("of"), "code", "count", "best")
    rows = slices.select("slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return rows.groupBy("slice").cogroup(found.groupBy("of")).applyInArrow(_answer, _OUT)


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``documents`` by the public byte-level BPE of 50k ids and the public pieces of 32k ids."""
    import public_tokenizers

    return align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
