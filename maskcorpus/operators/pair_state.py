"""Kept state of the vocabulary learner: words, and the pair table.

Words are dealt into shards once. A shard holds the symbols of its words and
their corpus counts, some 60 bytes a word, as it crosses into Python in every
round; a batch of merges scans the symbols for the merged pairs, rewrites only
the words that hold them, and answers with the change of every pair's count.
Pair shards hold pair -> count and apply the changes. All of it is numpy
arrays, so that a shard is one cached element of a Spark partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

#: Symbol ids are 32-bit: a pair (left, right) is one long.
KEY = 1 << 31
GAP = -1
#: Places of words that a shard lays out at once; each takes some hundred bytes on the way.
BLOCK = 1 << 17
#: Pairs of a dense table of sums (8 bytes each): 2,000 symbols squared.
CELLS = 1 << 22


def pair_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a pair: the upper bits of a multiplicative hash."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their values; sums are whole numbers."""
    if not len(keys):
        return keys, values
    left, right = keys >> 31, keys & (KEY - 1)
    width = int(right.max()) + 1
    cells = (int(left.max()) + 1) * width
    # many keys of a small range are added up in place; sums of floats are exact below 2^53
    if cells <= min(CELLS, 8 * len(keys)) and float(np.abs(values).sum(dtype=np.float64)) < 1 << 52:
        cell = left * width + right
        total = np.bincount(cell, values, cells)
        held = np.zeros(cells, bool)
        held[cell] = True
        cell = np.flatnonzero(held)
        return cell // width * KEY + cell % width, total[cell].astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def dealt(keys: np.ndarray, values: np.ndarray, shards: int, kind: str) -> Iterable[tuple[int, tuple]]:
    """(shard, (kind, keys, values)) for the pair shards."""
    at = pair_shard(keys, shards)
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(at[part[0]]), (kind, keys[part], values[part])


def merged(flat: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    """``flat`` with each pair (a, b) replaced by ``new``, left to right and without overlap."""
    at = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b))
    if not len(at):
        return flat
    if a == b:  # of a run of overlapping places every second one counts
        run = np.cumsum(np.concatenate([[True], np.diff(at) != 1])) - 1
        start = at[np.concatenate([[True], np.diff(at) != 1])]
        at = at[(at - start[run]) % 2 == 0]
    flat = flat.copy()
    flat[at] = new
    return np.delete(flat, at + 1)


class Words:
    """A shard of the word table: symbols of word i are ``sym[start[i]:start[i] + size[i]]``, then a GAP or more; its count is ``n[i]``."""

    def __init__(self, words: Sequence[Sequence[int]], counts: Sequence[int]):
        self.size = np.fromiter(map(len, words), np.int32, len(words))
        self.n = np.fromiter(counts, np.int64, len(counts))
        self.sym = np.fromiter((s for w in words for s in (*w, GAP)), np.int32, int(self.size.sum()) + len(words))
        self._place()

    def _place(self) -> None:
        """Where the words begin, with one GAP behind each."""
        self.start = (np.cumsum(self.size + 1, dtype=np.int64) - self.size - 1).astype(np.int32)

    def blocks(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows, cut where their places pass another BLOCK."""
        if not len(rows):
            return []
        at = np.cumsum(self.size[rows] + 1, dtype=np.int64) // BLOCK
        return np.split(rows, np.flatnonzero(np.diff(at)) + 1)

    def flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the given words with a GAP behind each word, and the word of every place."""
        size = self.size[rows].astype(np.int64) + 1
        owner = np.repeat(rows, size)
        first = np.cumsum(size) - size
        return self.sym[np.repeat(self.start[rows] - first, size) + np.arange(len(owner))], owner

    def _places(self, pairs: np.ndarray) -> Iterable[tuple[np.ndarray, np.ndarray]]:
        """Blocks of the places where one of the pairs (ascending keys) stands, and which."""
        if not len(pairs) or not len(self.sym):
            return
        symbols = max(int(self.sym.max()), int((pairs >> 31).max()), int((pairs & (KEY - 1)).max()))
        left, right = (np.zeros(symbols + 2, bool) for _ in range(2))  # the last is that of a GAP
        left[pairs >> 31] = right[pairs & (KEY - 1)] = True
        width = symbols + 1
        table = None
        if width * width <= CELLS // 4:  # few symbols, so most places pass the test by sides
            table = np.full(width * width, -1, np.int32)
            table[(pairs >> 31) * width + (pairs & (KEY - 1))] = np.arange(len(pairs))
        for first in range(0, len(self.sym) - 1, BLOCK):
            part = self.sym[first:first + BLOCK + 1]
            at = np.flatnonzero(left[part[:-1]] & right[part[1:]])
            if table is not None:
                which = table[part[at] * width + part[at + 1]].astype(np.int64)
                hit = which >= 0
            else:
                keys = part[at].astype(np.int64) * KEY + part[at + 1]
                which = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
                hit = pairs[which] == keys
            yield first + at[hit], which[hit]

    def _owner(self, at: np.ndarray) -> np.ndarray:
        """The words that stand at the places."""
        return np.searchsorted(self.start, at, "right") - 1

    def holding(self, keys: np.ndarray) -> np.ndarray:
        """The words that hold any of the pairs."""
        found = [self._owner(at) for at, _ in self._places(np.unique(keys))]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs and their weighted counts."""
        parts = [_NOTHING]
        for rows in self.blocks(np.arange(len(self.n))):
            flat, owner = self.flat(rows)
            keys, at = pairs_of(flat)
            parts.append(summed(keys, self.n[owner[at]]))
        return summed(*_joined(parts))

    def apply(self, merges: Sequence[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Carry out merges (left, right, new) in order; the pairs whose counts change, and by how much."""
        # a pair with a symbol made in this batch stands only where the merge that made it did
        rows = self.holding(np.array([a * KEY + b for a, b, _ in merges], np.int64))
        changes = [_NOTHING, *(self._merge(part, merges) for part in self.blocks(rows))]
        if len(self.sym) > 2 * (int(self.size.sum(dtype=np.int64)) + len(self.size)):
            self.sym = np.concatenate([self.flat(x)[0] for x in self.blocks(np.arange(len(self.n)))])
            self._place()
        keys, change = summed(*_joined(changes))
        return keys[change != 0], change[change != 0]

    def _merge(self, rows: np.ndarray, merges: Sequence[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Merges in the given words: the change of counts."""
        flat, owner = self.flat(rows)
        old, at = pairs_of(flat)
        lost = -self.n[owner[at]]
        for a, b, new in merges:
            flat = merged(flat, a, b, new)
        gaps = np.flatnonzero(flat == GAP)
        size = np.diff(np.concatenate([[-1], gaps])) - 1
        owner = np.repeat(rows, size + 1)
        places = np.repeat(self.start[rows] - (gaps - size), size + 1) + np.arange(len(flat))
        before = self.size[rows].astype(np.int64)
        freed = before - size
        tail = np.cumsum(freed) - freed
        self.sym[places] = flat
        self.sym[np.repeat(self.start[rows] + size + 1 - tail, freed) + np.arange(int(freed.sum()))] = GAP
        self.size[rows] = size
        keys, at = pairs_of(flat)
        return summed(np.concatenate([old, keys]), np.concatenate([lost, self.n[owner[at]]]))

    def triples(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weighted counts of ``x a b`` and ``a b y`` for the given pairs (ascending).

        A triple's key is its pair's place in ``pairs``, the side, and the other symbol.
        """
        parts = [_NOTHING]
        for at, which in self._places(pairs):
            weight = self.n[self._owner(at)]
            # behind every word is a GAP, so both stay inside (before the first place comes the last)
            for side, other in ((0, self.sym[at - 1]), (1, self.sym[at + 2])):
                real = other != GAP
                parts.append(summed((which[real] * 2 + side) * KEY + other[real], weight[real]))
        return summed(*_joined(parts))


_NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _joined(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = zip(*parts)
    return np.concatenate(keys), np.concatenate(values)


def pairs_of(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places of the adjacent pairs."""
    at = np.flatnonzero((flat[:-1] != GAP) & (flat[1:] != GAP)) if len(flat) else np.zeros(0, np.int64)
    return flat[at].astype(np.int64) * KEY + flat[at + 1], at


class Pairs:
    """A shard of the pair table."""

    def __init__(self):
        self.keys = self.n = np.zeros(0, np.int64)

    def change(self, keys: np.ndarray, by: np.ndarray) -> None:
        keys, by = summed(keys, by)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        self.n[at[known]] += by[known]
        gone = np.flatnonzero(self.n <= 0)
        if len(gone) or not known.all():
            kept, count = np.delete(self.keys, gone), np.delete(self.n, gone)
            new, more = keys[~known], by[~known]
            at = np.searchsorted(kept, new)
            self.keys, self.n = np.insert(kept, at, new), np.insert(count, at, more)

    def head(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The first pairs by count, descending, then key."""
        keys, n = self.keys, self.n
        if len(n) > most:
            least = np.partition(n, len(n) - most)[len(n) - most]
            above = n > least
            ties = np.flatnonzero(n == least)[:most - int(above.sum())]  # keys ascend, so these are the smallest
            pick = np.concatenate([np.flatnonzero(above), ties])
            keys, n = keys[pick], n[pick]
        order = np.lexsort((keys, -n))
        return keys[order], n[order]
