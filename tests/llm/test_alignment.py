"""op13 against a plain alignment, token by token, with the libraries' own encoders."""

import hashlib
import random
from collections import Counter

import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.alignment import op13
from tidemark.llm.bpe import byte_signs

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _brute(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    signs = byte_signs()

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for d, t in rows:
        want = f" {t}".encode() if t else b""
        xs = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(f" {t}", add_special_tokens=False).ids] if t else []
        ys = [(i, b_bytes(i)) for i in b.encode(t)] if t else []
        if b"".join(x for _, x in xs) != want or b"".join(y for _, y in ys) != want:
            xs, ys = [], []
        spans = []
        for side in (xs, ys):
            at, out = 0, []
            for i, s in side:
                out.append((i, at, at + len(s)))
                at += len(s)
            spans.append(out)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(x[0]) for x in s if lo <= x[1] < hi) for s in spans))
        docs.append((d, len(xs), len(ys), groups, links))
    total = Counter(p for x in docs for p in x[4])
    top = Counter()
    for (_, y), n in total.items():
        top[y] = max(top[y], n)
    return [(d, na, nb, len(g), len(ls), sum(total[p] == top[p[1]] for p in ls), sum(total[p] for p in ls),
             hashlib.sha256(";".join(g).encode()).hexdigest() if na else "") for d, na, nb, g, ls in docs]


def _key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def _rows(small):
    r = random.Random(5)
    parts = ["the ", "Tokeni", "zation", " ", "  ", "\n", "é", "ß", "😀", "漢字", "12", "x", ", ", "<s>", "<|endoftext|>", "\t", "\x00"]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for k in range(200)]
    rows += [(900, None), (901, ""), (902, "a▁b"), (903, " "), (904, "▁"), (None, "no id"), (5, "again"), (5, "again")]
    return rows + [(1000 + x.doc_id, x.text) for x in small.limit(12).collect() if len(x.text or "") < 3000]


def test_query_equals_brute_force(spark, make, small):
    rows = _rows(small)
    got = [tuple(x) for x in op13(spark, make(rows)).select(*COLUMNS).collect()]
    assert _key(got) == _key(_brute(rows))


def test_slices_do_not_matter(spark, make, small, monkeypatch):
    rows = _rows(small)[:120]
    want = _key(tuple(x) for x in op13(spark, make(rows)).select(*COLUMNS).collect())
    a, b = alignment._both(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    names = alignment._names(max(len(a.pieces), len(b.pieces)))
    whole = alignment.Slice([t or "" for _, t in rows], a, b, names)
    assert sum(whole.n) == sum(whole.n_links) == sum(x[4] for x in want)
    one = [alignment.Slice([t or ""], a, b, names) for _, t in rows]
    assert [s.sha[0] for s in one] == whole.sha
    assert [int(s.n_groups[0]) for s in one] == whole.n_groups.tolist()


def test_long_text_without_common_ends(spark, make):
    rows = [(1, "漢" * 5000), (2, "ab" * 40_000), (3, None)]
    got = {x.doc_id: x for x in op13(spark, make(rows)).collect()}
    for d in (1, 2):
        assert got[d].n_links == got[d].n_a + got[d].n_b - got[d].n_groups and got[d].n_a > 100
    assert got[3].n_links == 0 and got[3].groups_sha256 == ""


def test_no_rows(spark, make):
    assert op13(spark, make([])).collect() == []
    assert [tuple(x)[1:] for x in op13(spark, make([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_words_have_the_ids_of_whole_texts(small):
    side = alignment.PieceSide(public_tokenizers.path("piece_bpe_32k.model"))
    assert side.by_word
    texts = [t for _, t in _rows(small) if t] + [" ", "   ", " a", "a ", "  a   b  ", "\ta \n b", "a" * 3000]
    ids, at = side.encode(texts)
    assert [ids[p:q].tolist() for p, q in zip(at[:-1], at[1:])] == side.model.encode(texts)
    side.by_word = False
    again, _ = side.encode(texts)
    assert (again == ids).all()
