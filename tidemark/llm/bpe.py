"""Token ids of whole texts from a public byte-level BPE file, many texts at a time.

Byte-level BPE works on pre-tokens (words with their leading blank, numbers,
runs of signs, white space), each on its own.  Here a block of texts is cut into
pre-tokens with numpy, and the merges run once for each distinct pre-token in a
Python worker, as long as it stays in the worker's bounded table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np

from tidemark.llm.bytesops import mix

U = np.uint64
#: Distinct pre-tokens that a worker remembers.
REMEMBER = 1_500_000
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Fixed values of the pre-token pattern: endings split off after an apostrophe,
#: and the white space characters above ASCII.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
WIDE_SPACE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

_classes = None
_rng = np.random.default_rng(77)
_STEP = U(0x9E3779B97F4A7C15)


def char_classes() -> np.ndarray:
    """Class of every code point."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        _classes = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        _classes[[*range(9, 14), 32, *WIDE_SPACE]] = SPACE
    return _classes


def pre_tokens(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start of each pre-token in the code points of texts that begin at ``first``.

    The pattern: an apostrophe with one of ENDINGS; a run of letters, numbers or
    other signs, each with one blank before it; white space up to a following
    sign's own blank.
    """
    n = len(points)
    kind = char_classes()[points]
    begin = np.zeros(n, bool)
    begin[first] = True
    blank, space = points == 32, kind == SPACE
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    after_blank = np.zeros(n, bool)  # a sign whose one leading blank belongs to it
    after_blank[1:] = blank[:-1] & ~space[1:] & ~begin[1:]
    # the last white space of a run goes with the next sign, or stands alone
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~begin[1:]
    start = begin | last | (change & ~after_blank)
    quotes = np.flatnonzero((points == 39) & start)
    if len(quotes):
        ends = np.append(first[1:], n)[np.searchsorted(first, quotes, "right") - 1]
        for ending in ENDINGS:
            hit = quotes + len(ending) < ends
            for k, c in enumerate(ending):
                hit &= points[np.minimum(quotes + k + 1, n - 1)] == ord(c)
            at = quotes[hit]
            start[at + 1] = False
            after = at + 1 + len(ending)
            after = after[after < n]
            start[after] = start[after] | ~space[after]
    return np.flatnonzero(start)


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable
    Latin-1 signs stand for themselves, the other bytes for signs from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids by a ``tokenizers`` file, the same as encoding each text by itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.merge = self._merges(path, set(added))
        self._clear()

    def _merges(self, path: str, added: set[int]):
        """Encoder of one pre-token: the file's own merges, run by ``tiktoken``, which
        takes a fifth of the time on single words, if ids follow the order of merges."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, signs = model["vocab"], byte_signs()
        pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if [vocab[p] for p in pairs] != list(range(256, 256 + len(pairs))):
            return lambda words: [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        ranks = {bytes(signs[c] for c in token): i for token, i in vocab.items() if i not in added}
        merge = tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda words: [merge(w) for w in words]

    def _clear(self) -> None:
        self.known, self.flat = np.zeros(0, np.uint64), [np.zeros(0, np.uint32)]
        self.at, self.n, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Take new pre-tokens (ascending keys) into the table."""
        if len(self.known) + len(keys) > REMEMBER:
            self._clear()
        ids = self.merge(words)
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for w in ids for x in w), np.uint32, int(n.sum()))
        at = self.size + np.cumsum(n) - n
        self.size += len(flat)
        self.flat = [np.concatenate((*self.flat, flat))]
        place = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, place, keys)
        self.at, self.n = np.insert(self.at, place, at), np.insert(self.n, place, n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids before each text: n + 1 counts)."""
        odd = {i: self.tokenizer.encode(t, add_special_tokens=False).ids
               for i, t in enumerate(texts) if any(s in t for s in self.special)}
        plain = [("" if i in odd else t) for i, t in enumerate(texts)]
        lengths = np.fromiter(map(len, plain), np.int64, len(plain))
        text = "".join(plain)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ids, counts = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(points):
            doc_at = np.cumsum(lengths) - lengths
            starts = pre_tokens(points, doc_at[lengths > 0])
            size = np.diff(np.append(starts, len(points)))
            keys = self._keys(points, starts, size)
            new_keys, one, place = np.unique(keys, return_index=True, return_inverse=True)
            if len(self.known):
                k = np.searchsorted(self.known, new_keys)
                k[k == len(self.known)] = 0
                fresh = self.known[k] != new_keys
            else:
                fresh = np.ones(len(new_keys), bool)
            before = len(self.known)
            if fresh.any():
                words = [text[a:a + s] for a, s in zip(starts[one[fresh]].tolist(), size[one[fresh]].tolist())]
                self._learn(new_keys[fresh], words)
                if len(self.known) < before + len(words):  # the table was begun anew
                    rest = ~fresh
                    words = [text[a:a + s] for a, s in zip(starts[one[rest]].tolist(), size[one[rest]].tolist())]
                    if words:
                        self._learn(new_keys[rest], words)
            k = np.searchsorted(self.known, new_keys)[place]
            n, at = self.n[k], self.at[k]
            before_token = np.concatenate(([0], np.cumsum(n)))
            ids = self.flat[0][np.arange(before_token[-1]) - np.repeat(before_token[:-1] - at, n)]
            token_at = np.searchsorted(starts, np.append(doc_at, len(points)))
            counts = np.diff(before_token[token_at])
        if odd:
            parts, at = [], 0
            for i, c in enumerate(counts.tolist()):
                parts.append(np.array(odd[i], np.uint32) if i in odd else ids[at:at + c])
                at += c
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            ids = np.concatenate(parts)
        return ids, np.concatenate(([0], np.cumsum(counts)))

    @staticmethod
    def _keys(points: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """64-bit hash of each pre-token."""
        h = size.astype(np.uint64)
        alive = np.arange(len(starts))
        for k in range(int(size.max())):
            alive = alive[size[alive] > k] if k else alive
            if k > 64:  # few and long: hashed one by one
                for i in alive.tolist():
                    piece = points[starts[i] + k:starts[i] + size[i]].tobytes()
                    h[i] ^= U(int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little"))
                break
            h[alive] = (h[alive] ^ points[starts[alive] + k]) * _STEP
            if k % 4 == 3:
                h[alive] ^= h[alive] >> U(29)
        return mix(h)
