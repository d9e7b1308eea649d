"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of the n-grams it holds anywhere: runs of three
and of five bytes, and runs of words that repeat the word before them.  Each
indicator is scaled by its class log-count ratio (naive Bayes), the scaled vector
by its length, and a linear hinge-loss model over them is fitted by dual
coordinate descent.  A sigmoid turns margins into probabilities; it is fitted on
margins that cross-validation gives for texts the model had not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import words
from tidemark.llm.common import doc_slices, table, text_buffer, texts
from tidemark.llm.lang_id import held_out

#: Hash space of the indicators; the last REPEATS places are runs of repeated words.
BITS, REPEATS = 17, 4
SIZE = (1 << BITS) + REPEATS
#: Labelled documents of each class that the model learns from (the bound on
#: what the driver holds), and what the fit is made with.
SAMPLE_DOCS = 2000
SMOOTH, COST, EPOCHS, FOLDS, SEED = 1.0, 1.0, 12, 4, 5
THRESHOLD = 0.3


class Model(NamedTuple):
    """Weight of each indicator before scaling by length, bias, sigmoid."""

    weights: np.ndarray
    norms: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Ascending indicator places of each text; a text's n-grams never cross its ends."""
    seen = np.zeros(SIZE, np.uint8)
    hashes, counts = words(data, offsets)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    wide = data.astype(np.uint32)
    down = np.uint32(32 - BITS)
    three = five = np.zeros(0, np.uint32)
    if len(data) > 2:
        three = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    if len(data) > 4:
        five = ((three[:-2] * np.uint32(0x01000193)) ^ (three[2:] * np.uint32(0x85EBCA6B)) | np.uint32(1)) \
            * np.uint32(0xC2B2AE35) >> down
    three = (three + np.uint32(1)) * np.uint32(0x9E3779B1) >> down
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        seen[three[lo:max(hi - 2, lo)]] = 1
        seen[five[lo:max(hi - 4, lo)]] = 1
        run = same[counts[i]:counts[i + 1]].copy()
        run[:1] = False
        for k in range(REPEATS):  # a repeated word, then two in a row, and so on
            if not run.any():
                break
            seen[(1 << BITS) + k] = 1
            run = run[1:] & run[:-1]
        at = np.flatnonzero(seen)
        seen[at] = 0
        yield at


def _ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of (share of the indicator in class 1 / in class 0), smoothed."""
    share = []
    for label in (1, -1):
        n = np.full(SIZE, SMOOTH)
        for x in (rows[i] for i in np.flatnonzero(y == label)):
            n[x] += 1
        share.append(n / n.sum())
    return np.log(share[0] / share[1])


def _descend(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(ratios, weights, bias) by dual coordinate descent on the hinge loss; classes weigh alike."""
    ratio = _ratios(rows, y)
    values = [ratio[x] / max(np.sqrt((ratio[x] ** 2).sum()), 1e-9) for x in rows]
    cost = {label: COST * len(y) / (2 * max((y == label).sum(), 1)) for label in (1, -1)}
    w, bias, alpha = np.zeros(SIZE), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            x, v = rows[i], values[i]
            slope = y[i] * (v @ w[x] + bias) - 1
            new = min(max(alpha[i] - slope / (v @ v + 1.0), 0.0), cost[y[i]])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    return ratio, w, bias


def _margin(x: np.ndarray, ratio: np.ndarray, w: np.ndarray, bias: float) -> float:
    r = ratio[x]
    return float(r @ w[x] / max(np.sqrt(r @ r), 1e-9) + bias)


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability's sigmoid, by Newton steps on the log loss."""
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        theta += np.linalg.solve(hess, x.T @ (t - p))
    return float(theta[0]), float(theta[1])


def train(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """Fit to indicator places and labels 1 / -1."""
    fold = np.random.default_rng(SEED).permutation(len(y)) % FOLDS
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        here = np.flatnonzero(fold != k)
        if len(set(y[here].tolist())) == 2:
            part = _descend([rows[i] for i in here], y[here])
            for i in np.flatnonzero(fold == k):
                margin[i] = _margin(rows[i], *part)
    ratio, w, bias = _descend(rows, y)
    slope, shift = _sigmoid(margin, y)
    return Model((ratio * w).astype(np.float32), (ratio ** 2).astype(np.float32), bias, max(slope, 1e-3), shift)


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """Train on a bounded sample of labelled documents.

    ``labels``: ``doc_id``, ``quality`` (1 or 0; other values are ignored).
    About SAMPLE_DOCS ids of each class are drawn by hash; only their indicator
    places reach the driver.  With fewer than two classes the result is the
    share of class 1 (0.5 without labels), as a constant score.
    """
    labels = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in labels.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    rate = F.when(F.col("quality") == 1, SAMPLE_DOCS / counts[1]).otherwise(SAMPLE_DOCS / counts[0])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1e6
    chosen = F.broadcast(labels.filter(draw < rate))  # about SAMPLE_DOCS rows of each class

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, 1 << 20):
            x = [pa.array(at, pa.int32()) for at in indicators(*text_buffer(part.column("text")))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(
                [a.to_pylist() for a in x], pa.list_(pa.int32()))], names=["doc_id", "quality", "x"])

    sample = texts(docs).join(chosen, "doc_id").mapInArrow(places, "doc_id long, quality int, x array<int>").toArrow()
    order = np.lexsort((sample["quality"].to_numpy(), sample["doc_id"].to_numpy()))
    x = sample["x"].combine_chunks()
    rows = [x[int(i)].values.to_numpy() for i in order]
    y = np.where(sample["quality"].to_numpy()[order] == 1, 1, -1)
    return train(rows, y) if len(set(y.tolist())) == 2 else float(counts[1] >= counts[0])


def quality(docs: DataFrame, model: Model | float) -> DataFrame:
    """``doc_id``, ``score`` (probability of quality 1, by the whole text), ``predicted`` (score >= 0.3).

    Null and empty texts get the score of a text without n-grams.  One row per
    input row, with repeated or null ids too; extra columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, 1 << 20):
            if isinstance(model, float):
                p = np.full(part.num_rows, model)
            else:
                margin = np.array([model.weights[x].sum(dtype=np.float64)
                                   / max(np.sqrt(model.norms[x].sum(dtype=np.float64)), 1e-9)
                                   for x in indicators(*text_buffer(part.column("text")))]) + model.bias
                p = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30)))
            p = np.round(p, 6)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(score, "doc_id long, score double, predicted int")


def op5(spark, sf_dir: str) -> DataFrame:
    """``quality`` of all documents, learned from four fifths of ``labels``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality(docs, fit(docs, labels.filter(~held_out(F.col("doc_id"), 5, 0))))
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
