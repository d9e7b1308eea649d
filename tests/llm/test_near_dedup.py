"""op4 against brute force; signatures; components."""

import collections
import itertools
import random

import numpy as np

from tidemark.llm.components import connected_components
from tidemark.llm.near_dedup import PLACES, near_dedup, op4, superminhash


def brute(docs, width=2, percent=80):
    sets = []
    for _, t in docs:
        x = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (t or "").encode().split()]
        sets.append({tuple(x)} if 0 < len(x) < width else {tuple(x[k:k + width]) for k in range(len(x) - width + 1)})
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    having = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for z in s:
            having[z].append(i)
    common = collections.Counter(p for v in having.values() for p in itertools.combinations(v, 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)], least[root(i)] == d) for i, (d, _) in enumerate(docs))


def corpus(seed):
    r = random.Random(seed)
    voc = [f"w{i}" for i in range(40)]
    docs = []
    for _ in range(10):
        base = [r.choice(voc) for _ in range(r.choice([1, 2, 3, 6, 30, 90, 400]))]
        for _ in range(r.randint(1, 20)):
            copy = list(base)
            for _ in range(int(len(copy) * r.choice([0, 0, 0.02, 0.04, 0.06, 0.09]))):
                copy[r.randrange(len(copy))] = r.choice(voc)
            docs.append((len(docs) * 13 % 1009, " ".join(x.upper() if r.random() < 0.3 else x for x in copy)))
    return docs + [(5000, None), (5001, ""), (5002, " \n"), (5003, "w1 W1\tw2")]


def test_equals_brute_force(spark, make):
    docs = corpus(7)
    assert sorted(map(tuple, op4(spark, make(docs)).collect())) == brute(docs)
    assert sorted(map(tuple, near_dedup(make(docs), 5).collect())) == brute(docs, 5)


def test_equals_brute_force_on_the_table(spark, small):
    docs = [tuple(x) for x in small.collect()]
    assert sorted(map(tuple, op4(spark, small).collect())) == brute(docs)


def test_null_ids_repeated_ids_and_no_rows(spark, make):
    got = near_dedup(make([(None, "a b c"), (1, "a b c"), (1, "x y z"), (2, "a b c")]), 2).collect()
    assert sorted((str(x.doc_id), str(x.component_id), x.kept) for x in got) == [
        ("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True)]
    assert near_dedup(make([])).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        x = rng.integers(0, 2**63, 3000).astype(np.uint64)
        n = int(1000 * (1 - share) / (1 + share))
        a, b = np.sort(x[:1000]), np.sort(x[n:1000 + n])
        sig = superminhash(np.concatenate((a, b)), np.array([0, 1000, 2000]))
        assert sig.shape == (2, PLACES)
        assert abs((sig[0] == sig[1]).mean() - (1000 - n) / (1000 + n)) < 0.09
    one = superminhash(np.array([5], np.uint64), np.array([0, 1, 1]))
    assert sorted((one[0] >> 23).tolist()) == list(range(PLACES)) and (one[1] == 0xFFFFFFFF).all()


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = connected_components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
