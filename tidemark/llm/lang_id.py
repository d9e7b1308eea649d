"""Language identification by a byte convolutional network, trained and run in numpy.

A text is cut into fixed-length windows of bytes.  A window's bytes are embedded,
filters of several widths slide over them, each filter keeps its largest
response in the window, and a softmax layer turns the responses into languages.
A document's probabilities are the mean over all its windows, by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_slices, text_buffer, texts

#: Bytes of a window, embedding size, filter widths and filters of each width.
WINDOW, EMBED, WIDTHS, FILTERS = 256, 6, (2, 3, 4, 5), 8
#: Labelled documents of each language and of all languages together, and windows of
#: each, that the network learns from (the bound on what the driver holds).
SAMPLE_DOCS, SAMPLE_TOTAL, SAMPLE_WINDOWS = 800, 80_000, 4
#: Training steps (as many again for every LANGS_PER_RUN languages), rows of a step, rate.
STEPS, LANGS_PER_RUN, BATCH, RATE, SEED = 300, 16, 64, 0.015, 11
UNKNOWN = "und"
_WIDEST = max(WIDTHS)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Network(NamedTuple):
    """Embedding (256 x EMBED), filters, their bias, output weights and bias, languages."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    langs: list[str]


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text has this remainder (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def to_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows padded with zeros for the widest filter, document and bytes of each)."""
    n = np.diff(offsets)
    per = -(-n // WINDOW)
    doc = np.repeat(np.arange(len(n)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    size = np.minimum(n[doc] - nth * WINDOW, WINDOW)
    at = (offsets[doc] + nth * WINDOW)[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    out = np.zeros((len(doc), WINDOW + _WIDEST - 1), np.uint8)
    if len(doc):
        out[:, :WINDOW] = np.where(inside, _FOLD[data[np.minimum(at, len(data) - 1)]], 0)
    return out, doc, size


def _columns(windows: np.ndarray, embed: np.ndarray) -> np.ndarray:
    """The widest filter's view at every place: (windows, WINDOW, widest * EMBED)."""
    e = np.ascontiguousarray(embed[windows])
    return np.lib.stride_tricks.as_strided(
        e, (len(windows), WINDOW, _WIDEST * EMBED), (e.strides[0], e.strides[1], e.strides[2]), writeable=False)


def _responses(windows: np.ndarray, net: Network) -> tuple[np.ndarray, np.ndarray]:
    cols = _columns(windows, net.embed).reshape(-1, _WIDEST * EMBED)
    return cols, (cols @ net.filters).reshape(len(windows), WINDOW, -1)


def probabilities(windows: np.ndarray, net: Network) -> np.ndarray:
    out = np.empty((len(windows), len(net.langs)))
    for i in range(0, len(windows), 32):  # small enough to stay in the cache
        top = _responses(windows[i:i + 32], net)[1].max(axis=1)
        z = np.maximum(top + net.bias, 0) @ net.out + net.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        out[i:i + 32] = z / z.sum(axis=1, keepdims=True)
    return out


def train(windows: np.ndarray, target: np.ndarray, langs: list[str]) -> Network:
    """Adam on the cross entropy; every language is drawn equally often, and some
    windows are shortened so that short texts are known too."""
    rng = np.random.default_rng(SEED)
    n_filters = len(WIDTHS) * FILTERS
    mask = np.zeros((_WIDEST * EMBED, n_filters), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
    p = [rng.normal(0, 0.5, (256, EMBED)), rng.normal(0, 0.3, mask.shape) * mask, np.zeros(n_filters),
         rng.normal(0, 0.3, (n_filters, len(langs))), np.zeros(len(langs))]
    p = [x.astype(np.float32) for x in p]
    p[0][0] = 0  # padding
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    rows = [np.flatnonzero(target == k) for k in range(len(langs))]
    steps = STEPS * max(1, len(langs) // LANGS_PER_RUN)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(langs), BATCH)
        pick = np.array([rows[k][rng.integers(len(rows[k]))] for k in pick])
        x, y = windows[pick].copy(), target[pick]
        for i in np.flatnonzero(rng.random(BATCH) < 0.3).tolist():
            x[i, int(WINDOW * rng.random() ** 2) + 8:] = 0
        net = Network(*p, langs)
        cols, z = _responses(x, net)
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + p[2]
        h = np.maximum(top, 0)
        z = h @ p[3] + p[4]
        q = np.exp(z - z.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        q[np.arange(BATCH), y] -= 1
        q /= BATCH
        dh = (q @ p[3].T) * (top > 0)
        best = cols.reshape(BATCH, WINDOW, -1)[np.arange(BATCH)[:, None], at]  # (batch, filter, column)
        d_filters = np.einsum("bfc,bf->cf", best, dh) * mask
        d_cols = dh[:, :, None] * p[1].T[None]
        d_embed = np.zeros_like(p[0])
        for j in range(_WIDEST):
            np.add.at(d_embed, x[np.arange(BATCH)[:, None], at + j], d_cols[:, :, j * EMBED:(j + 1) * EMBED])
        d_embed[0] = 0
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in enumerate((d_embed, d_filters, dh.sum(0), h.T @ q, q.sum(0))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)
    return Network(*[x.astype(np.float32) for x in p], langs)


def fit(labelled: DataFrame) -> Network | None:
    """Train on a bounded sample of ``doc_id``, ``text``, ``lang``.

    About SAMPLE_DOCS documents of each language (fewer of each if there are more than a
    hundred languages) are drawn by a hash of their ids, and SAMPLE_WINDOWS places of
    each by another; only these windows and a count per language reach the driver.  Every
    language is learned, whatever their number.  None if no language is there.
    """
    labelled = labelled.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    langs = sorted(r["lang"] for r in counts)
    each = min(SAMPLE_DOCS, max(SAMPLE_TOTAL // len(langs), 1))
    rates = F.broadcast(labelled.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, each / r["n"])) for r in counts], "lang string, rate double"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1e6
    place = F.explode(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1))).alias("k")
    windows = (labelled.join(rates, "lang").filter(draw < F.col("rate")).select("doc_id", "lang", "text", place)
               .withColumn("at", F.pmod(F.xxhash64("doc_id", "k"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1))
               .select("doc_id", "k", "lang", F.substring("text", F.col("at").cast("int") + 1, F.lit(WINDOW)).alias("w"))
               .collect())
    windows.sort(key=lambda r: (r["doc_id"], r["k"], r["w"]))
    raw = [r["w"].encode()[:WINDOW] for r in windows]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    number = {lang: k for k, lang in enumerate(langs)}
    target = np.array([number[r["lang"]] for r in windows])
    here = [k for k in range(len(langs)) if (target == k).any()]
    if not here:
        return None
    return train(to_windows(data, offsets)[0], np.searchsorted(here, target), [langs[k] for k in here])


def language_id(docs: DataFrame, net: Network | None, *keep: str) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and the columns named in ``keep``, by whole texts.

    ``keep`` may name ``text`` (null then comes back empty).

    ``score`` is the mean probability of the predicted language over the text's
    windows.  A null text, a text without letters, or no network at all gives
    ``und`` with score 0.  Ties go to the first language by name.  One row per
    input row, with repeated or null ids too; extra columns are ignored.
    """
    rows = texts(docs, *(c for c in keep if c != "text"))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), *keep)
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in doc_slices(batches, 1 << 20):
            windows, doc, size = to_windows(*text_buffer(part.column("text")))
            total = np.zeros((part.num_rows, len(net.langs)))
            np.add.at(total, doc, probabilities(windows, net) * size[:, None])
            total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
            best = total.argmax(axis=1)
            score = np.clip(np.round(total[np.arange(len(best)), best], 6), 0, 1)
            letter = part.column("has_letter").to_numpy(zero_copy_only=False)
            pred = np.where(letter, np.array(net.langs, object)[best], UNKNOWN)
            cols = [part.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.where(letter, score, 0.0))]
            yield pa.RecordBatch.from_arrays(cols + [part.column(c) for c in keep],
                                             names=["doc_id", *schema.names, *keep])

    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.withColumn("has_letter", F.col("text").rlike(r"\p{L}")).mapInArrow(
        predict, "doc_id long, lang_pred string, score double" + kept)


def known_language(docs: DataFrame, net: Network | None, *columns: str) -> DataFrame:
    """The rows of ``docs`` whose language ``net`` tells, with ``doc_id`` and the columns named.

    Texts without letters, empty and null texts go.  Without a network (no labelled text
    in the corpus) nothing can be told and every row stays.  Rows with repeated or null
    ids are judged by their own texts; no rows give no rows."""
    if net is None:
        return docs.select("doc_id", *columns)
    return language_id(docs, net, *columns).filter(F.col("lang_pred") != UNKNOWN).select("doc_id", *columns)


def op1(spark, docs: DataFrame) -> DataFrame:
    """``language_id`` of all documents, learned from three quarters of the labelled ones."""
    labelled = texts(docs, "lang").filter(~held_out(F.col("doc_id"), 4, 2))
    out = language_id(docs, fit(labelled))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
