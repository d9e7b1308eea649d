"""op2: token ids equal the tokenizer's; sequences hold what fits, without gaps."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.bpe import Encoder
from tidemark.llm.packing import best_fit_runs, op2, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_the_tokenizers(small):
    r = random.Random(3)
    parts = ["a", "B", "'s", "'", "'re", "'ll x", " ", "  ", "\n", "\t", "1", "23", "é", "!", "$$", "　", "the", " it's",
             "<|endoftext|>", "😀", "'S", "\x1c", "٣", "’s", "_", "''s", "!'s", "x" * 90]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(1500)] + [""]
    texts += [x.text for x in small.limit(60).collect()]
    ids, at = (e := Encoder(PATH)).encode(texts)
    whole = Tokenizer.from_file(PATH)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids
    again, _ = e.encode(texts)
    assert (again == ids).all()


def test_packs_every_piece_once(spark, make, small):
    whole = Tokenizer.from_file(PATH)
    docs = [tuple(x) for x in small.collect()] + [(5000, None), (5001, ""), (None, "a b"), (3, "x"), (5002, "q " * 5000)]
    got = op2(spark, make(docs)).collect()
    want = []
    for d, t in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        n = len(ids)
        cuts = [0, n] if n <= 1024 else sorted({0, *range(n % 1024 or 1024, n + 1, 1024)})
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert Counter(tuple(x)[:5] for x in got) == Counter(want)
    seqs = defaultdict(list)
    for x in got:
        seqs[x.sequence_id].append((x.offset, x.length))
    for v in seqs.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(seqs) <= 1.03 * -(-sum(x.length for x in got) // 1024) + 1


def test_no_rows_and_ids(spark, make):
    assert op2(spark, make([])).collect() == []
    x = pack_documents(make([(1, "hello")]), PATH).first()
    assert x.ids[-1] == 2 and x.length == len(x.ids)


@pytest.mark.parametrize("seed", range(30))
def test_rules_are_a_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([1, 2, 7, 64])
    counts = {s: r.randint(1, 40) for s in r.sample(range(1, capacity + 1), r.randint(1, min(capacity, 12)))}
    placed, bins = Counter(), defaultdict(list)
    for length, lo, hi, first, per, at in best_fit_runs(counts, capacity):
        for k in range(hi - lo):
            bins[first + k // per].append((at + k % per * length, length))
            placed[length] += 1
    assert placed == counts
    for v in bins.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= capacity
    # the same number of sequences as one piece after the other, largest first
    gaps = []
    for s in sorted(counts, reverse=True):
        for _ in range(counts[s]):
            fit = [g for g in gaps if g >= s]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - s)
            else:
                gaps.append(capacity - s)
    assert len(bins) == len(gaps)
