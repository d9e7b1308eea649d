"""op8 and op9 against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import repeats
from tidemark.llm.substring_dedup import op8, substring_dedup
from tidemark.llm.suffix_dedup import COVER, COVER_MOD, op9, suffix_dedup


def brute_words(docs, width=13):
    words = [(t or "").encode().split() for _, t in docs]
    first = {}
    for (d, _), x in zip(docs, words):
        for k in range(len(x) - width + 1 if d is not None else 0):
            key = tuple(x[k:k + width])
            first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), x in zip(docs, words):
        gone = [False] * len(x)
        for k in range(len(x) - width + 1 if d is not None else 0):
            if first[tuple(x[k:k + width])] < d:
                gone[k:k + width] = [True] * width
        kept = b" ".join(w for w, g in zip(x, gone) if not g)
        out.append((d, len(x), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(docs, length=200):
    seen = collections.Counter()
    texts = [(t or "").encode() for _, t in docs]
    for (d, _), b in zip(docs, texts):
        for k in range(len(b) - length + 1 if d is not None else 0):
            seen[b[k:k + length]] += 1
    out = []
    for (d, _), b in zip(docs, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1 if d is not None else 0):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    voc = ["ab", "the", "é", "zz9", "on", "q" * 3]
    base = [" ".join(r.choice(voc) for _ in range(r.randint(0, 300))) for _ in range(30)]
    docs = []
    for i in range(90):
        t = r.choice(base)
        if r.random() < 0.5:
            k, u = r.randint(0, len(t)), r.choice(base)
            t = t[:k] + u[r.randint(0, len(u)):]
        docs.append((i * 7 % 90 - 5, t))
    return docs + [(200, None), (201, ""), (202, "a" * 900), (None, base[0]), (3, base[1]), (3, base[2] + base[1]),
                   (203, "x y \x0b z" * 40), (204, " \n\t")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [5, 6])
def test_equal_brute_force(spark, make, seed, monkeypatch):
    docs = corpus(seed)
    assert rows(op8(spark, make(docs))) == brute_words(docs)
    assert rows(op9(spark, make(docs))) == brute_bytes(docs)


def test_shared_passages(spark, make):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(9))
    passage = " ".join(word() for _ in range(60))
    docs = [(i, " ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(i))) for i in range(30)]
    got = {x.doc_id: x for x in substring_dedup(make(docs)).collect()}
    assert got[0].spans == [] and got[0].kept_text == docs[0][1].strip()
    assert all([(s.start, s.end) for s in got[i].spans] == [(40, 100)] for i in range(1, 30))
    cut = {x.doc_id: x for x in suffix_dedup(make(docs)).collect()}
    assert all(passage.encode() not in cut[i].kept and cut[i].spans for i in range(30))


def test_empty_table(spark, make):
    assert rows(op8(spark, make([]))) == rows(op9(spark, make([]))) == []


def test_cover_meets_every_pair():
    for i in range(COVER_MOD):
        for j in range(COVER_MOD):
            assert any((i + d) % COVER_MOD in COVER and (j + d) % COVER_MOD in COVER for d in range(COVER_MOD))


def test_packing_keeps_values():
    rng = np.random.default_rng(0)
    for n in (1, 2, 1000):
        x = np.sort(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        assert (repeats.unpack(repeats.pack(x)) == x).all()
        y = rng.integers(-(2**62), 2**62, n)
        assert (repeats.unpack_ids(repeats.pack_ids(y)) == y).all()
