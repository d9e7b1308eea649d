"""MinHash near-dedup with SuperMinHash signatures.

A document's set is its distinct word shingles.  SuperMinHash gives every shingle
one random permutation of the signature's places; in step t the shingle offers
``t + r_t`` at its t-th place, and each place keeps the least offer.  The ranks
within a permutation are correlated, which lowers the variance against
independent minima, and a document stops as soon as no place can improve.

Permutations are the affine maps ``t -> a t + b`` modulo a prime, with a and b
drawn from the shingle: uniform over places, pairwise as a random permutation,
and computed without a table.

Signatures are cut into bands; documents that share a band are candidates; the
candidates' full shingle sets decide; links become groups by union-find.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import STEP, distinct_by_doc, mix, word_windows, words
from tidemark.llm.common import doc_slices, staged, text_buffer, texts
from tidemark.llm.components import connected_components

U = np.uint64
#: Places of a signature (a prime), and bands of rows each.  At a similarity of
#: 0.8 a pair shares no band with probability (1 - 0.8**6)**42 < 3e-6.
PLACES, BANDS, ROWS = 257, 42, 6
#: Bits of the random part of an offer; the step stands above them.
FINE = 23
#: Shingles by which sets of 32-bit hashes may misjudge a pair (two chance ties).
SLACK = 4
#: Members of a band that are compared in one task.
TILE = 2048
SLICE = 1 << 20


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, and n + 1 offsets.

    Words fold A-Z; a document of fewer words than ``width`` has its whole
    sequence as one shingle, one without words has none.
    """
    hashes, counts = words(data, offsets, lower=True)
    values, doc = word_windows(hashes, counts, width)
    n = np.diff(counts)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        more = np.empty(len(short), np.uint64)
        for k, i in enumerate(short.tolist()):
            h = int(n[i])
            for w in hashes[counts[i]:counts[i + 1]].tolist():
                h = (h * STEP + w) % (1 << 64)
            more[k] = h
        values, doc = np.concatenate((values, mix(mix(more)))), np.concatenate((doc, short))
        order = np.argsort(doc, kind="stable")
        values, doc = values[order], doc[order]
    return distinct_by_doc(values, doc, len(n))


def superminhash(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signatures (documents x PLACES) of the sets values[offsets[i]:offsets[i + 1]]."""
    n = len(offsets) - 1
    sig = np.full(n * PLACES, 0xFFFFFFFF, np.uint32)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    seed = mix(values + U(STEP))
    mult = (seed % U(PLACES - 1) + U(1)).astype(np.int64)
    place = ((seed >> U(32)) % U(PLACES)).astype(np.int64)
    for t in range(PLACES):
        fine = mix(values + U((t + 1) * STEP % (1 << 64))) >> U(64 - FINE)
        np.minimum.at(sig, doc * PLACES + place, (fine | U(t << FINE)).astype(np.uint32))
        place = (place + mult) % PLACES
        # the next offers are at least t + 1: a document with less everywhere is done
        active = (sig.reshape(n, PLACES).max(axis=1) >> FINE) > t
        if not active.all():
            go = active[doc]
            if not go.any():
                break
            values, doc, mult, place = values[go], doc[go], mult[go], place[go]
    return sig.reshape(n, PLACES)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Hash of each band's places (documents x BANDS)."""
    rows = sig[:, :BANDS * ROWS].reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        h = mix(h * U(STEP) + rows[:, :, k])
    return h.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                     ("bands", pa.list_(pa.int64()))])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (digest of the set, null if empty), ``bands``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, SLICE):
            values, at = shingles(*text_buffer(part.column("text")), width)
            n = np.diff(at)
            keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if a < b else None
                    for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            bands = band_keys(superminhash(values, at))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS),
                                             pa.array(bands.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(keys, pa.binary()), bands],
                                             schema=_SIGNED)

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def short_sets(docs: DataFrame, width: int) -> DataFrame:
    """``node``, ``hashes``: the documents' shingle sets as ascending 32-bit hashes."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, SLICE):
            values, at = shingles(*text_buffer(part.column("text")), width)
            short = [np.unique(values[a:b].astype(np.uint32)).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(short, pa.binary())],
                                             names=["node", "hashes"])

    return docs.mapInArrow(shorten, "node long, hashes binary")


def _likely(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Pairs of one tile of a band, from different groups, that may be links.

    A member's surest link to another group stands for all to that group; where
    none is sure by the short hashes, all that may be one are given.
    """

    def judge(t: pa.Table) -> pa.Table:
        node, group, block = (t.column(c).to_numpy() for c in ("node", "component", "block"))
        crossed = t.column("tile_i")[0].as_py() != t.column("tile_j")[0].as_py()
        sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("hashes")]
        size = np.array([len(x) for x in sets])
        values = np.concatenate(sets)
        order = np.argsort(values)
        values, owner = values[order], np.repeat(np.arange(len(node)), size)[order]
        _, inverse, members = np.unique(group, return_inverse=True, return_counts=True)
        main = inverse == members.argmax()  # all others against all that are not in their group
        out = []
        for i in np.flatnonzero(~main).tolist():
            other = (group != group[i]) & (main | (node > node[i]))
            if crossed:
                other &= block != block[i]
            lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
            n = hi - lo
            at = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
            common = np.bincount(owner[at], minlength=len(node))
            margin = 100 * common - percent * (size[i] + size - common)
            other = np.flatnonzero(other & (margin >= -100 * SLACK))
            for g in np.unique(group[other]).tolist():
                mine = other[group[other] == g]
                best = mine[margin[mine].argmax()]
                for j in [best] if margin[best] > 100 * SLACK else mine.tolist():
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return judge


def verified(pairs: DataFrame, candidates: DataFrame, width: int, percent: int) -> DataFrame:
    """``a``, ``b``, ``linked``: pairs whose whole shingle sets reach ``percent`` similarity."""
    left = candidates.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = candidates.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[str, np.ndarray] = OrderedDict()

        def own(text: str) -> np.ndarray:
            if text not in recent:
                raw = text.encode()
                recent[text] = shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), width)[0]
                if len(recent) > 200:
                    recent.popitem(last=False)
            recent.move_to_end(text)
            return recent[text]

        for batch in batches:
            linked = []
            for s, t in zip(batch.column("text_a"), batch.column("text_b")):
                x, y = own(s.as_py()), own(t.as_py())
                common = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])

    # the pivot side first: its rows are only ids then; texts of a hot pivot are made while streaming
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a long, b long, linked boolean")


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Groups of near-duplicate documents by word-shingle similarity.

    Words are runs of bytes other than blank and 0x09-0x0D with A-Z folded; a
    document's set is its distinct ``width``-word shingles (fewer words: the
    whole sequence as one).  Documents are linked if 100 * intersection >=
    ``percent`` * union of their full sets.  Returns one row per input row:
    ``doc_id``, ``n_shingles``, ``component_id`` (least doc_id reachable over
    links, itself included) and ``kept`` (doc_id = component_id).

    Equal sets are one node from the start, so copies cost one row each and are
    never paired.  Within a shared band, members are compared with two pivots.
    Members of bands that are then still in different groups are judged tile by
    tile within the band, by short hashes of their whole sets; one sure link
    between a member and another group is enough, and it is compared in full.  So
    a large group of copies costs pairs in proportion to its size, and no link
    between groups is lost.

    Null or empty texts and texts without words are linked with nothing.  Rows
    that repeat a ``doc_id`` are grouped by their own texts; where that id is the
    least of two sets, these count as linked.  A row with a null ``doc_id`` takes
    no part: its component_id is null and it is kept.  Extra columns are ignored.
    """
    rows = texts(docs)
    signed = staged(signatures(rows, width), "signatures")
    with_id = signed.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    sets = staged(with_id.groupBy("set_key").agg(F.min(F.struct("doc_id", "bands")).alias("first"))
                  .select("set_key", F.col("first.doc_id").alias("node"), "first.bands"), "sets", release=True)
    entries = sets.select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    members = staged(entries.join(shared.filter("low < high").select("band"), "band"), "members", release=True)
    candidates = staged(rows.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"),
                        "candidates", release=True)
    groups = _grouped(members, candidates, width, percent)
    of_set = (sets.select("set_key", "node").join(groups, "node", "left")
              .select("set_key", F.coalesce("component", "node").alias("component")))
    out = signed.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _grouped(members: DataFrame, candidates: DataFrame, width: int, percent: int) -> DataFrame:
    """``node``, ``component`` of the nodes that share bands (``members``: band, node)."""
    # the least node of a band, and the least by another order, against the rest
    order = F.struct(F.xxhash64("node").alias("o"), "node")
    pivots = members.groupBy("band").agg(F.min("node").alias("p"), F.min(order).alias("q"))
    pivots = pivots.select("band", F.explode(F.array_distinct(F.array("p", "q.node"))).alias("pivot"))
    pairs = members.join(pivots, "band").filter("node <> pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    checked = staged(verified(pairs, candidates, width, percent), "pairs")
    links = checked.filter("linked").select("a", "b")
    groups = connected_components(links)
    labelled = members.join(groups, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component"))
    # bands whose members are in several groups still hold open pairs
    spread = labelled.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("low"),
                                          F.max("component").alias("high")).filter("low < high")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    still = staged(labelled.join(spread.select("band", tiles.alias("tiles")), "band"), "open")
    nodes = still.select(F.col("node").alias("doc_id")).distinct()
    dealt = (still.join(short_sets(candidates.join(nodes, "doc_id", "left_semi"), width), "node")
             .withColumn("block", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    likely = (dealt.select("band", F.least("block", "other").alias("tile_i"), F.greatest("block", "other").alias("tile_j"),
                           "block", "node", "component", "hashes")
              .groupBy("band", "tile_i", "tile_j").applyInArrow(_likely(percent), "a long, b long").distinct())
    likely = likely.join(checked.select("a", "b"), ["a", "b"], "left_anti")
    more = staged(verified(likely, candidates, width, percent), "pairs").filter("linked").select("a", "b")
    roots = groups.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                               .join(groups, "node", "left_anti").withColumn("component", F.col("node")))
    return connected_components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def op4(spark, docs: DataFrame) -> DataFrame:
    """``near_dedup`` on two-word shingles at a similarity of 0.8."""
    return near_dedup(docs, 2, 80)
