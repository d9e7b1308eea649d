"""Phrases whose words keep company, from exact counts of word sequences.

Counts are held in weighted automata (``automata``).  A task sorts the word
sequences of a shard of text into one count transducer per language and range of
prefixes (the hash of the first two words, so a frequent first word is spread);
transducers of one range meet, and their union sums the weights up.

Two rounds: words and pairs first, then sequences of three to five words along
pairs that are frequent in the corpus, since a sequence is no more frequent than a
pair in it.  Which pairs are frequent is told to the tasks by a bit map of fixed size
over hashes of pairs: a pair set by chance costs time, never a count.

The parts of a candidate are looked up by composing the automaton of the asked parts
with the count transducer of their range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.automata import Transducer, arcs, sorted_codes
from tidemark.llm.bytesops import STEP, U, mix, prefix_hash, powers, word_spans
from tidemark.llm.common import doc_slices, n_buckets, staged, text_buffer

#: Words of one shard, and text bytes that are cut into words at a time.
SHARD, SLICE = 3_000_000, 1 << 20
#: Bits of the map of frequent pairs.
BITS = 1 << 27
#: Tasks that rank phrases of a language before these meet.
RANKERS = 64
#: Fixed: marks that end a piece, and what stands between words.
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _MARK.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_DEALT = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("blob", pa.binary())])
_FOUND = "lang string, phrase string, m int, f long, bit long"


def split_words(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words in lower case, whether each begins a piece, words before each text)."""
    data, offsets = text_buffer(batch.column("text"))
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, bool), np.zeros(len(offsets), np.int64)
    data = _LOWER[data]
    starts, ends = word_spans(data, offsets, _BETWEEN)
    marks = np.cumsum(_MARK[data])
    first = np.searchsorted(starts, offsets)
    begins = np.ones(len(starts), bool)
    begins[1:] = marks[starts[1:]] != marks[starts[:-1]]
    begins[first[first < len(starts)]] = True
    at = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(at), pa.py_buffer(data[~_BETWEEN[data]])])
    return words, begins, first


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """64-bit hash of each word, another one in each language."""
    data, offsets = text_buffer(words)
    seed = U(int.from_bytes(lang.encode()[:8].ljust(8, b"\0"), "little"))
    out = np.empty(len(words), np.uint64)
    lo = 0
    while lo < len(words):  # blocks, so that the tables of powers stay small
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20), "right")) - 1)
        s, e = offsets[lo:hi] - offsets[lo], offsets[lo + 1:hi + 1] - offsets[lo]
        p, q = prefix_hash(data[offsets[lo]:offsets[hi]]), powers(int(e[-1]) + 1)[1]
        out[lo:hi] = (p[e] - p[s]) * q[s]
        lo = hi
    return mix(out ^ seed)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U(STEP) + second)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """Which of the equal ranges of 64-bit numbers each is in."""
    return ((h >> U(32)) * U(ranges) >> U(32)).astype(np.int64)


def _cut(words: pa.Array, top: np.ndarray, second: np.ndarray, deeper: list, counts: list) -> Transducer:
    """Transducer of one range: arcs of the first two levels by label, deeper levels by place."""
    level1, at = arcs(np.zeros(len(top), np.int64), top, counts[0], len(words))
    level2, place = arcs(at[second[0]] if len(second[0]) else second[0], second[1], counts[1], len(words))
    levels, state = [level1, level2], place
    for (parent, label), n in zip(deeper, counts[2:]):
        level, state = arcs(state[parent], label, n, len(words))
        levels.append(level)
    used, codes = np.unique(np.concatenate([x.label for x in levels]), return_inverse=True)
    at = np.cumsum([0] + [len(x.label) for x in levels])
    levels = [x._replace(label=codes[a:b]) for x, a, b in zip(levels, at[:-1], at[1:])]
    return Transducer(words.take(pa.array(used)), levels)


def _dealt(lang: str, ranges: int, cuts: Iterator[tuple[int, Transducer]]) -> pa.RecordBatch | None:
    rows = [(lang, k, t.to_bytes()) for k, t in cuts]
    if not rows:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DEALT)], schema=_DEALT)


def _pairs(lang: str, words: pa.Array, begins: np.ndarray, ranges: int) -> Iterator[tuple[int, Transducer]]:
    """Count transducers of a shard's words and pairs, one for each range of prefixes."""
    words, codes = sorted_codes(words)
    n, h = len(words), word_hashes(words, lang)
    singles = np.bincount(codes, minlength=n)
    at = np.flatnonzero(~begins[1:])
    pairs, count = np.unique(codes[at] * n + codes[at + 1], return_counts=True)
    first, second = pairs // n, pairs % n
    own, of_pair = _range_of(mix(h), ranges), _range_of(pair_hashes(h[first], h[second]), ranges)
    by_own, by_pair = np.argsort(own, kind="stable"), np.argsort(of_pair, kind="stable")
    a, b = (np.searchsorted(x[o], np.arange(ranges + 1)) for x, o in ((own, by_own), (of_pair, by_pair)))
    for k in np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0)).tolist():
        w, p = by_own[a[k]:a[k + 1]], by_pair[b[k]:b[k + 1]]
        lead, to = np.unique(first[p], return_inverse=True)  # arcs that only lead to pairs weigh nothing here
        top = np.concatenate((w, lead))
        weigh = np.concatenate((singles[w], np.zeros(len(lead), np.int64)))
        yield k, _cut(words, top, (len(w) + to, second[p]), [], [weigh, count[p]])


def _longer(lang: str, words: pa.Array, begins: np.ndarray, ranges: int, bits: np.ndarray,
            longest: int) -> Iterator[tuple[int, Transducer]]:
    """Count transducers of a shard's sequences of three words and more whose pairs may be frequent."""
    words, codes = sorted_codes(words)
    n, h = len(words), word_hashes(words, lang)
    pair = pair_hashes(h[codes[:-1]], h[codes[1:]])
    bit = (pair % U(BITS)).astype(np.int64)
    ok = ~begins[1:] & ((bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1) == 1)
    at = np.flatnonzero(ok[:-1] & ok[1:])
    if not len(at):
        return
    of = _range_of(pair[at], ranges)
    key = (of * n + codes[at]) * n + codes[at + 1] if ranges * n * n < 1 << 62 else None
    if key is None:
        _, key = np.unique(codes[at] * n + codes[at + 1], return_inverse=True)
        _, key = np.unique(of * (len(key) + 1) + key, return_inverse=True)
    _, one, state = np.unique(key, return_index=True, return_inverse=True)
    lead, second, of = codes[at[one]], codes[at[one] + 1], of[one]  # pairs, by range
    deep, places = [], at
    for d in range(2, longest):  # the arcs of level d + 1, sorted by parent and so by range
        level, place = arcs(state, codes[places + d], None, n)
        deep.append(level)
        more = places + d < len(ok)
        more[more] = ok[places[more] + d]
        state, places = place[more], places[more]
    ends = np.searchsorted(of, np.arange(ranges + 1))
    for k in np.flatnonzero(np.diff(ends)).tolist():
        lo, hi = int(ends[k]), int(ends[k + 1])
        top, to = np.unique(lead[lo:hi], return_inverse=True)
        zero, own, counts = np.zeros, [], []
        a, b = lo, hi
        for x in deep:
            p, q = np.searchsorted(x.parent, (a, b))
            own.append((x.parent[p:q] - a, x.label[p:q]))
            counts.append(x.weight[p:q])
            a, b = int(p), int(q)
        yield k, _cut(words, top, (to, second[lo:hi]), own, [zero(len(top), np.int64), zero(hi - lo, np.int64), *counts])


def _shards(docs: DataFrame, make, ranges: int) -> DataFrame:
    """``make``'s transducers of every shard, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def closed(lang: str) -> pa.RecordBatch | None:
            words, begins = zip(*held.pop(lang))
            size.pop(lang)
            words, begins = pa.concat_arrays(words), np.concatenate(begins)
            return _dealt(lang, ranges, make(lang, words, begins, ranges)) if len(words) else None

        for part in doc_slices(batches, SLICE):
            words, begins, first = split_words(part)
            langs = part.column("lang").to_pylist()
            new = np.flatnonzero([True, *(a != b for a, b in zip(langs[1:], langs[:-1]))])
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(langs)]):
                lang, a, b = langs[lo], int(first[lo]), int(first[hi])
                held.setdefault(lang, []).append((words.slice(a, b - a), begins[a:b]))
                size[lang] = size.get(lang, 0) + b - a
            while sum(size.values()) > SHARD:
                if (out := closed(max(size, key=size.get))) is not None:
                    yield out
        for lang in list(held):
            if (out := closed(lang)) is not None:
                yield out

    return docs.mapInArrow(run, "lang string, bucket int, blob binary")


def _frequent(dealt: DataFrame, least: int, counted: tuple[int, ...]) -> DataFrame:
    """Sequences of ``counted`` words that occur ``least`` times or more, by the union of each
    range's transducers.  A row with m = 0 holds the number of words."""

    def merge(t: pa.Table) -> pa.Table:
        lang = t.column("lang")[0].as_py()
        whole = Transducer.union([Transducer.from_bytes(b) for b in t.column("blob").to_pylist()])
        rows = {"phrase": [], "m": [], "f": [], "bit": []}
        words = int(whole.levels[0].weight.sum())
        if counted[0] == 1:
            rows = {"phrase": [pa.array([""])], "m": [np.zeros(1, np.int32)], "f": [np.array([words])], "bit": [np.zeros(1, np.int64)]}
        whole = whole.at_least(least, max(counted[0], 2))
        h = word_hashes(whole.words, lang)
        for m in counted:
            x = whole.levels[m - 1]
            ok = np.flatnonzero(x.weight >= least)
            bit = np.zeros(len(ok), np.int64)
            if m == 2:
                lead = whole.levels[0].label[x.parent[ok]]
                bit = (pair_hashes(h[lead], h[x.label[ok]]) % U(BITS)).astype(np.int64)
            for name, v in (("phrase", whole.phrases(m).take(pa.array(ok)).cast(pa.large_string()).cast(pa.string())),
                            ("m", np.full(len(ok), m, np.int32)), ("f", x.weight[ok]), ("bit", bit)):
                rows[name].append(v)
        cols = {"phrase": pa.concat_arrays(rows["phrase"])} | {c: pa.array(np.concatenate(rows[c])) for c in ("m", "f", "bit")}
        return pa.table({"lang": pa.array([lang] * len(cols["m"]), pa.string()), **cols})

    return dealt.groupBy("lang", "bucket").applyInArrow(merge, _FOUND)


def _bit_map(pairs: DataFrame) -> np.ndarray:
    """BITS bits, those of the pairs set (Spark makes its parts; their size is fixed)."""
    place = F.col("bit") + 1
    parts = pairs.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts:
        bits = np.frombuffer(r["bits"], np.uint8)
        out[(r["part"] - 1) * len(bits):r["part"] * len(bits)] = bits
    return out


def sequence_counts(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """(``lang, phrase, m, f``: every sequence of up to ``longest`` words that occurs ``least``
    times or more in a language; ``lang, n``: words of each language).

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and these
    into words at blanks and tabs; sequences lie within pieces and overlap.  Null
    text counts as empty, null ``lang`` as ``und``.  Every row counts, repeated ones
    too; ``doc_id`` is not used and extra columns are ignored.
    """
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = n_buckets(docs)
    short = staged(_frequent(_shards(own, _pairs, ranges), least, (1, 2)), "pairs")
    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(short.filter("m = 2")))

    def make(lang: str, words: pa.Array, begins: np.ndarray, ranges: int) -> Iterator[tuple[int, Transducer]]:
        return _longer(lang, words, begins, ranges, bits.value, longest)

    counts = short.filter("m > 0")
    if longest > 2:
        long = staged(_frequent(_shards(own, make, ranges), least, tuple(range(3, longest + 1))), "sequences")
        counts = counts.unionByName(long)
    totals = short.filter("m = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return counts.select("lang", "phrase", "m", "f"), totals


def part_counts(counts: DataFrame, asked: DataFrame, ranges: int, longest: int) -> DataFrame:
    """``asked`` (distinct ``lang, phrase``) with the counts ``f`` of its phrases.

    Both sides are dealt to ranges by their first two words; there the automaton of
    the asked phrases is composed with the count transducer."""

    def compose(have: pa.Table, want: pa.Table) -> pa.Table:
        out = want.select(["lang", "phrase"])
        if not len(have) or not len(want):
            return out.slice(0, 0).append_column("f", pa.array([], pa.int64()))
        known = Transducer.of_phrases(have.column("phrase").combine_chunks(), have.column("f").to_numpy(), longest)
        phrases = want.column("phrase").combine_chunks()
        query = Transducer.of_phrases(phrases, np.ones(len(want), np.int64), longest)
        rows = [(query.phrases(d).filter(pa.array(x.weight > 0)), f[x.weight > 0])
                for d, (x, f) in enumerate(zip(query.levels, known.lookup(query)), 1) if len(x.label)]
        found = pa.concat_arrays([p for p, _ in rows]).cast(pa.large_string()).cast(pa.string())
        f = np.concatenate([f for _, f in rows])
        lang = pa.array([have.column("lang")[0].as_py()] * len(found), pa.string())
        return pa.table({"lang": lang, "phrase": found, "f": pa.array(f)}).filter(pa.array(f > 0))

    key = F.pmod(F.xxhash64("lang", F.substring_index("phrase", " ", 2)), F.lit(ranges)).alias("range")
    have, want = (x.select("lang", "phrase", *more, key) for x, more in ((counts, ["f"]), (asked, [])))
    want = want.select(*(F.col(c).alias(f"_{c}") for c in want.columns)).toDF(*want.columns)
    return (have.groupBy("lang", "range").cogroup(want.groupBy("lang", "range"))
            .applyInArrow(compose, "lang string, phrase string, f long"))


def _whole(c: Column | str) -> Column:
    return F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are phrases of 2 to ``longest`` words with a = f(phrase) >= ``least``.  A
    cut after the first words gives l = f(first part), r = f(rest) and
    score = floor(1000 * a * n / (l * r)), exactly; the lowest-scoring cut counts, ties
    to the earliest.  A candidate inside a longer one that occurs as often is dropped.
    Texts, nulls and repeated rows as in ``sequence_counts``; no rows, no phrases.
    """
    counts, totals = sequence_counts(docs, least, longest)
    candidates = counts.filter("m > 1").withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
            .withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice(words, F.col("k") + 1, F.col("m") - F.col("k")), " ")))
    asked = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    parts = staged(part_counts(counts, asked, n_buckets(docs), longest), "parts")

    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(totals, "lang"))
    # 1000 a n has at most 38 digits while the corpus has under 1e17 words
    scored = scored.withColumn("_over", _whole(F.col("a") * 1000) * _whole("n")).withColumn("_under", _whole("l") * _whole("r"))
    best = scored.withColumn("score", F.expr("_over div _under")).groupBy("lang", "phrase", "m", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a longer phrase that occurs as often as this one holds one that is longer by a word
    inner = candidates.filter("m > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("m") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("m") - 1), " "))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").filter("_longer IS NULL OR _longer < a")
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # ranked in parts first, so that no task takes a language whole
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKERS))).orderBy(*order)
    kept = kept.withColumn("_nth", F.row_number().over(some)).filter(F.col("_nth") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return kept.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``collocations`` of ``documents``: phrases of 2 to 5 words, 100 occurrences, 2,000 a language."""
    return collocations(docs)
