"""op12: automata round trips, and collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import collocations as c
from tidemark.llm.automata import Transducer


def _brute(rows, least, longest, top):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        f = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    return df.selectExpr("*", "1 AS m", "2 AS f", "3 AS bucket", "'x' AS phrase", "0 AS doc_id").repartition(3)


def _rows(seed, n, kinds=6):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(kinds)] + ["É", "the", "The", "ß\x01", "x_y"]
    rows = []
    for _ in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]) for _ in range(r.randint(0, 40)))
        rows.append((r.choice(["en", "en", "de", None, "und", ""]), text))
    return rows + [("en", None), ("de", ""), ("en", " .,"), ("fr", None)] + [("en", "a long passage that comes again and again")] * 7


@pytest.mark.parametrize("least,longest,top", [(3, 5, 2000), (2, 4, 7), (1, 5, 50), (3, 2, 10)])
def test_equals_plain_counting(spark, least, longest, top):
    rows = _rows(least * 10 + longest, 60)
    got = sorted(tuple(x) for x in c.collocations(_docs(spark, rows), least, longest, top).collect())
    assert got == _brute(rows, least, longest, top)


def test_shards_and_ranges_do_not_matter(spark, monkeypatch):
    rows = _rows(1, 80)
    make = [(lambda *a: c._pairs(*a), 2), (lambda *a: c._longer(*a, np.full(c.BITS // 8, 255, np.uint8), 5), 5)]
    for fn, depth in make:
        totals = []
        for ranges in (1, 7):
            sums = Counter()
            for lang in ("en", "de"):
                texts = [t or "" for x, t in rows if x == lang]
                batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
                words, begins, _ = c.split_words(batch)
                for _, t in fn(lang, words, begins, ranges):
                    back = Transducer.from_bytes(t.to_bytes())
                    for d in range(len(back.levels)):
                        assert back.phrases(d + 1).equals(t.phrases(d + 1))
                        for p, w in zip(back.phrases(d + 1).to_pylist(), back.levels[d].weight.tolist()):
                            sums[lang, p] += w
            totals.append(+sums)
        assert totals[0] == totals[1] and len(totals[0])
        for (lang, p), w in totals[0].items():
            size = p.count(b" ") + 1
            assert size <= depth
            want = 0
            for x, t in rows:
                if x == lang:
                    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
                        ws = [v.encode() for v in re.split("[ \t]", piece) if v]
                        want += sum(b" ".join(ws[i:i + size]) == p for i in range(len(ws) - size + 1))
            assert w == want


@pytest.mark.parametrize("seed", range(20))
def test_automata(seed):
    r = random.Random(seed)

    def some(n):
        return Counter(" ".join(r.choice("abcdé") for _ in range(r.randint(1, 4))) for _ in range(n))

    def of(x):
        return Transducer.of_phrases(pa.array(list(x), pa.string()), np.array(list(x.values()), np.int64), 4)

    def back(t):
        return +Counter({p.decode(): w for d in range(len(t.levels))
                         for p, w in zip(t.phrases(d + 1).to_pylist(), t.levels[d].weight.tolist())})

    parts = [some(r.randint(1, 80)) for _ in range(4)]
    made = [of(x) for x in parts]
    assert [back(m) for m in made] == parts
    assert [back(Transducer.from_bytes(m.to_bytes())) for m in made] == parts
    whole = Transducer.union(made)
    assert back(whole) == sum(parts, Counter())
    asked = some(40) + Counter({"z": 1, "a z": 1})
    query = of(asked)
    found = {p.decode(): f for d, fs in enumerate(whole.lookup(query)) for p, f in zip(query.phrases(d + 1).to_pylist(), fs.tolist())}
    assert all(found[p] == back(whole)[p] for p in asked)


def test_equal_futures_are_written_once():
    pairs = [f"a{i} b{j}" for i in range(30) for j in range(30)]
    short, long = (Transducer.of_phrases(pa.array([p + end for p in pairs]), np.ones(900, np.int64), 4) for end in ("", " c d"))
    assert [len(v.label) for v in long.levels] == [30, 900, 900, 900]
    assert len(long.to_bytes()) < len(short.to_bytes()) + 100


def test_no_rows(spark):
    assert c.collocations(_docs(spark, []).filter("m = 0")).collect() == []
    assert c.collocations(_docs(spark, [("en", None), (None, "")])).collect() == []
