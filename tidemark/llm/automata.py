"""Weighted acyclic automata over words: counts of word sequences, in numpy arrays.

A count transducer reads a sequence of words and gives its count.  While it is made
or merged it is a tree: level d holds an arc for each sequence of d words, as (parent
arc of level d - 1, label, weight), sorted by parent and label; labels are numbers of
a sorted vocabulary.  To travel, states with equal futures become one state (all
states without a way on, and all those with the same one or two arcs), and the
arrays are written in byte-aligned numbers.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.token_files import decode_ranks, encode_ranks

BLANK = b" "  # in no word


class Level(NamedTuple):
    parent: np.ndarray
    label: np.ndarray
    weight: np.ndarray


def sorted_codes(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Sorted distinct words (by bytes), and each word's number among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


def arcs(parent: np.ndarray, label: np.ndarray, weight: np.ndarray | None, labels: int) -> tuple[Level, np.ndarray]:
    """The level of all (parent, label), with weights summed up (none: 1 each), and the arc of each."""
    key = parent * labels + label
    if weight is None:
        distinct, place, n = np.unique(key, return_inverse=True, return_counts=True)
    else:
        distinct, place = np.unique(key, return_inverse=True)
        n = np.zeros(len(distinct), np.int64)
        np.add.at(n, place, weight)
    labels = max(labels, 1)
    return Level(distinct // labels, distinct % labels, n), place


class Transducer:
    """Counts of the sequences of some words: a vocabulary and its levels."""

    def __init__(self, words: pa.Array, levels: list[Level]):
        self.words, self.levels = words, levels

    @staticmethod
    def of_phrases(phrases: pa.Array, weights: np.ndarray, depth: int) -> Transducer:
        """Transducer of phrases (words joined by blanks), arc by arc in sorted order.

        Sequences that only lead to others have weight 0."""
        lists = pc.split_pattern(phrases.cast(pa.large_binary()), BLANK)
        words, codes = sorted_codes(pc.list_flatten(lists))
        size = pc.list_value_length(lists).to_numpy()
        first = np.cumsum(size) - size
        at, alive, levels = np.zeros(len(size), np.int64), np.arange(len(size)), []
        for d in range(depth):
            alive = alive[size[alive] > d]
            level, place = arcs(at[alive], codes[first[alive] + d], np.where(size[alive] == d + 1, weights[alive], 0), len(words))
            at[alive] = place
            levels.append(level)
        return Transducer(words, levels)

    @staticmethod
    def union(parts: list[Transducer]) -> Transducer:
        """Transducer of all parts' sequences, their weights summed up."""
        words, codes = sorted_codes(pa.concat_arrays([p.words for p in parts]))
        base = np.cumsum([0] + [len(p.words) for p in parts])
        depth = max(len(p.levels) for p in parts)
        state = [np.zeros(1, np.int64)] * len(parts)
        levels = []
        for d in range(depth):
            mine = [(i, p.levels[d]) for i, p in enumerate(parts) if d < len(p.levels)]
            level, place = arcs(np.concatenate([state[i][x.parent] for i, x in mine]),
                                np.concatenate([codes[base[i] + x.label] for i, x in mine]),
                                np.concatenate([x.weight for _, x in mine]), len(words))
            at = 0
            for i, x in mine:
                state[i] = place[at:at + len(x.label)]
                at += len(x.label)
            levels.append(level)
        return Transducer(words, levels)

    def at_least(self, least: int, first: int) -> Transducer:
        """Without the sequences of ``first`` words or more that weigh less than ``least``
        (a sequence never weighs more than what it begins with)."""
        levels, kept = [], np.zeros(1, np.int64)
        for d, x in enumerate(self.levels, 1):
            ok = kept[x.parent] >= 0
            if d >= first:
                ok &= x.weight >= least
            levels.append(Level(kept[x.parent[ok]], x.label[ok], x.weight[ok]))
            kept = np.where(ok, np.cumsum(ok) - 1, -1)
        return Transducer(self.words, levels)

    def phrases(self, d: int) -> pa.Array:
        """The sequences of level ``d`` (from 1), words joined by blanks."""
        at, columns = np.arange(len(self.levels[d - 1].label)), []
        for x in reversed(self.levels[:d]):
            columns.append(self.words.take(pa.array(x.label[at])))
            at = x.parent[at]
        return pc.binary_join_element_wise(*columns[::-1], pa.scalar(BLANK, self.words.type))

    def lookup(self, asked: Transducer) -> list[np.ndarray]:
        """Composition with the sequences ``asked``: each one's weight here, level by level
        (0 where it has none)."""
        code = pc.index_in(asked.words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        state, out, labels = np.zeros(1, np.int64), [], max(len(self.words), 1)
        for d, x in enumerate(asked.levels):
            if d >= len(self.levels) or not len(self.levels[d].label):
                state = np.full(len(x.label), -1)
                out.append(np.zeros(len(x.label), np.int64))
                continue
            own = self.levels[d]
            keys = own.parent * labels + own.label
            want = np.where((state[x.parent] >= 0) & (code[x.label] >= 0), state[x.parent] * labels + code[x.label], -1)
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            state = np.where(keys[place] == want, place, -1)
            out.append(np.where(state >= 0, own.weight[place], 0))
        return out

    # ------------------------------------------------------------ as bytes

    def to_bytes(self) -> bytes:
        """States with equal futures are written once."""
        out = [b"".join(x if i == 0 else BLANK + x for i, x in enumerate(self.words.to_pylist()))]
        future = np.zeros(len(self.levels[-1].label), np.int64)  # of each state of the level; 0: no way on
        tables = []
        for d in range(len(self.levels) - 1, -1, -1):
            x = self.levels[d]
            states = len(self.levels[d - 1].label) if d else 1
            n = np.bincount(x.parent, minlength=states)
            first = np.cumsum(n) - n
            _, arc = np.unique(x.label * (int(x.weight.max(initial=0)) + 1) + x.weight, return_inverse=True)
            _, arc = np.unique(arc * (int(future.max(initial=0)) + 1) + future, return_inverse=True)
            own, kept = np.zeros(states, np.int64), []
            for size in (1, 2):
                at = np.flatnonzero(n == size)
                key = arc[first[at]] if size == 1 else arc[first[at]] * (len(arc) + 1) + arc[first[at] + 1]
                _, one, same = np.unique(key, return_index=True, return_inverse=True)
                own[at] = 1 + sum(map(len, kept)) + same
                kept.append(at[one])
            at = np.flatnonzero(n > 2)
            own[at] = 1 + sum(map(len, kept)) + np.arange(len(at))
            kept = np.concatenate((*kept, at))
            take = np.repeat(first[kept] - (np.cumsum(n[kept]) - n[kept]), n[kept]) + np.arange(int(n[kept].sum()))
            tables.append((n[kept], x.label[take], x.weight[take], future[take]))
            future = own
        tables.append((future,))
        for table in tables[::-1]:
            for values in table:
                control, data = encode_ranks(values)
                out += [struct.pack("<II", len(values), len(data)), control.tobytes(), data.tobytes()]
        return struct.pack("<I", len(out[0])) + b"".join(out)

    @staticmethod
    def from_bytes(blob: bytes) -> Transducer:
        view, (size,) = memoryview(blob), struct.unpack_from("<I", blob)
        words = pa.array(bytes(view[4:4 + size]).split(BLANK), pa.large_binary())
        at = 4 + size

        def values() -> np.ndarray:
            nonlocal at
            n, m = struct.unpack_from("<II", blob, at)
            c = -(-n // 4)
            control = np.frombuffer(view, np.uint8, c, at + 8)
            out = decode_ranks(control, np.frombuffer(view, np.uint8, m, at + 8 + c), n)
            at += 8 + c + m
            return out.astype(np.int64)

        state, levels = values(), []
        while at < len(blob):
            n, label, weight, future = values(), values(), values(), values()
            n = np.concatenate(([0], n))
            first = np.cumsum(n) - n
            size = n[state]
            parent = np.repeat(np.arange(len(state)), size)
            take = np.repeat(first[state] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            levels.append(Level(parent, label[take], weight[take]))
            state = future[take]
        return Transducer(words, levels)
