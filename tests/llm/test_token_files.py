"""op11: the coding, and ids written to files and read back against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.token_files import decode_ranks, encode_ranks, op11, read_token_ids, write_token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 1000, 300_001])
def test_coding_round_trip(n):
    r = np.random.default_rng(n)
    v = r.integers(0, 1 << 32, n, dtype=np.uint64) >> r.integers(0, 32, n).astype(np.uint64)
    control, data = encode_ranks(v.astype(np.uint32))
    assert len(control) == -(-n // 4)
    assert (decode_ranks(control, data, n) == v).all()


def test_small_values_take_one_byte():
    control, data = encode_ranks(np.array([0, 255, 256, 65535, 65536, 1 << 24]))
    assert len(control) == 2 and len(data) == 1 + 1 + 2 + 2 + 3 + 4


def _want(rows):
    whole = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_query_equals_the_tokenizers_library(spark, make, small):
    rows = [tuple(x) for x in small.collect()] + [(90001, None), (90002, ""), (90003, "x<|endoftext|>y"), (-5, "é😀\n")]
    rows.sort()
    got = sorted(tuple(x) for x in op11(spark, make(rows)).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == [x[:4] for x in _want(rows)]


@pytest.mark.parametrize("file_bytes", [400, 5000, 1 << 30])
def test_files_of_any_size_hold_the_same_stream(spark, make, tmp_path, file_bytes):
    r = random.Random(1)
    rows = [(r.randint(-20, 20), " ".join(r.choice(["a", "bc", "12", "the", "é"]) for _ in range(r.randint(0, 60))))
            for _ in range(150)]
    rows += [(7, "same text")] * 40 + [(None, "no id"), (None, None), (3, "w " * 4000)]
    out = str(tmp_path / "t")
    write_token_ids(make(rows), PATH, out, file_bytes=file_bytes)
    got = sorted((x.start, x.doc_id, x.n_tokens, x.ids_crc32, x.ids) for x in read_token_ids(spark, out).collect())
    assert [x[1] for x in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [x[0] for x in got] == np.cumsum([0] + [x[2] for x in got])[:-1].tolist()
    want = sorted((d is not None, d or 0, n, crc, ids) for d, _, n, crc, ids in _want(rows))
    assert sorted((d is not None, d or 0, n, crc, ids) for _, d, n, crc, ids in got) == want
    names = sorted(p.name for p in (tmp_path / "t" / "ids").glob("part-*"))
    assert len(names) >= (1 if file_bytes > 5000 else 2)
    if file_bytes == 400:  # files follow the order of doc_id
        firsts = []
        for n in names:
            part = spark.read.format("binaryFile").load(str(tmp_path / "t" / "ids" / n))
            firsts.append(part.first().content)
        starts = [int.from_bytes(f[24:32], "little") for f in firsts if f]
        assert starts == sorted(starts)


def test_layout_does_not_matter(spark, make):
    rows = [(i % 7, f"text {i}") for i in range(60)]
    a, b = make(rows), make(rows[::-1]).repartition(5)
    assert sorted(map(tuple, op11(spark, a).collect())) == sorted(map(tuple, op11(spark, b).collect()))


def test_no_rows(spark, make):
    assert op11(spark, make([])).collect() == []


def test_ranks_follow_frequency(spark, make, tmp_path):
    out = str(tmp_path / "t")
    write_token_ids(make([(1, "a a a a b"), (2, "b")]), PATH, out)
    ranks = [tuple(x) for x in spark.read.parquet(f"{out}/ranks").orderBy("rank").select("id", "n").collect()]
    assert [n for _, n in ranks] == sorted((n for _, n in ranks), reverse=True)
    assert sum(n for _, n in ranks) == 8
