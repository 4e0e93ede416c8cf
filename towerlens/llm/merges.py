"""Vectorised merge rounds of byte pair encoders, over many words at once.

Symbols of all words lie in one flat array. In a round every word that still has
a pair to merge finds its least pair rank (a segmented minimum), merges all pairs of
that rank from left to right, skipping one that shares a symbol with the one before,
and the array is compacted; words without pairs leave it. This equals merging one
pair at a time, least rank first and leftmost among equals, unless a merge makes a
new pair of the same or a lower rank. Symbols that can do so are known from the
merge table; where one is made, only the leftmost pair of its word is merged in that
round. The rounds of a word are bounded by its length, so words above ``LONG``
symbols take the same merges one by one from a heap instead of holding up the rest.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np

#: Words of more symbols are merged from a heap.
LONG = 256

NONE = np.int32((1 << 31) - 1)  # rank of a pair that does not merge
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64((1 << 64) - 1)


def ragged_take(values: np.ndarray, ends: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``index`` of a list array (flat ``values``, n+1 ``ends``), as flat values and lengths."""
    size = np.diff(ends)[index]
    at = np.repeat(ends[:-1][index] - (np.cumsum(size) - size), size)
    return values[at + np.arange(len(at))], size


class Merges:
    """``pairs`` maps (left, right) symbols to (rank, symbol made); symbols are below 2**31."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.pairs = pairs
        key = np.array([l << 32 | r for l, r in pairs], dtype=np.uint64)
        value = np.array(list(pairs.values()), dtype=np.int32).reshape(-1, 2)
        self.shift = np.uint64(64 - max(4, int(8 * len(key)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.entry = np.full(size, _EMPTY), np.zeros(size, dtype=np.int32)
        slot = ((key * _SPREAD) >> self.shift).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):  # linear probing: the first of those that want a free slot gets it
            free = self.keys[slot[todo]] == _EMPTY
            at, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[at], self.entry[at] = key[won], won
            todo = np.setdiff1d(todo, won)
            slot[todo] = (slot[todo] + 1) % size
        self.rank = np.append(value[:, 0], NONE)
        self.made = np.append(value[:, 1], np.int32(-1))
        top = int(max(value.max(initial=0), (key >> np.uint64(32)).max(initial=0), (key & np.uint64(0xFFFFFFFF)).max(initial=0)))
        made_at = np.full(top + 1, -1, dtype=np.int64)  # the highest rank that makes a symbol
        np.maximum.at(made_at, value[:, 1], value[:, 0])
        self.alone = np.zeros(top + 1, dtype=bool)
        for side in (key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)):
            side = side.astype(np.int64)
            self.alone[side[value[:, 0] <= made_at[side]]] = True

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Entry of each pair; the last one (no merge) where it has none."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = ((key * _SPREAD) >> self.shift).astype(np.int64)
        met = self.keys[slot]
        out = np.where(met == key, self.entry[slot], np.int32(-1))
        todo = np.flatnonzero((met != key) & (met != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % len(self.keys)
            met = self.keys[slot[todo]]
            hit = met == key[todo]
            out[todo[hit]] = self.entry[slot[todo[hit]]]
            todo = todo[~hit & (met != _EMPTY)]
        return out

    def run(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of words given as flat symbols and n+1 ends; words are not empty."""
        size = np.diff(ends)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, their sizes, their symbols
        long = np.flatnonzero(size > LONG)
        for w in long.tolist():
            out = np.array(self.heap(symbols[ends[w]:ends[w + 1]].tolist()), dtype=np.int32)
            done.append((np.array([w]), np.array([len(out)]), out))
        word = np.flatnonzero(size <= LONG)
        sym, size = ragged_take(symbols.astype(np.int32), ends, word)
        entry = np.full(len(sym), -1, dtype=np.int32)
        if len(sym):
            entry[:-1] = self.find(sym[:-1], sym[1:])
            entry[np.cumsum(size) - 1] = -1
        while len(word):
            start = np.cumsum(size) - size
            rank = self.rank[entry]
            least = np.minimum.reduceat(rank, start)
            idle = least == NONE
            if idle.any():
                in_idle = np.repeat(idle, size)
                done.append((word[idle], size[idle], sym[in_idle]))
                keep = ~in_idle
                sym, entry, rank = sym[keep], entry[keep], rank[keep]
                word, size, least = word[~idle], size[~idle], least[~idle]
                if not len(word):
                    break
                start = np.cumsum(size) - size
            of = np.repeat(np.arange(len(word)), size)
            hit = np.flatnonzero(rank == least[of])
            begin = np.append(True, np.diff(hit) != 1)  # of a run of pairs that share symbols
            nth = np.arange(len(hit))
            hit = hit[(nth - np.maximum.accumulate(np.where(begin, nth, 0))) % 2 == 0]
            made = self.made[entry[hit]]
            risky = self.alone[made]
            if risky.any():
                held = np.zeros(len(word), dtype=bool)
                held[of[hit[risky]]] = True
                leftmost = np.append(True, of[hit[1:]] != of[hit[:-1]])
                stay = leftmost | ~held[of[hit]]
                hit, made = hit[stay], made[stay]
            sym[hit] = made
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            last = np.zeros(len(sym), dtype=bool)
            last[start + size - 1] = True
            last[hit] = last[hit + 1]
            changed = np.zeros(len(sym), dtype=bool)
            changed[hit] = True
            size = size - np.bincount(of[hit], minlength=len(word))
            sym, entry, last, changed = sym[keep], entry[keep], last[keep], changed[keep]
            changed[:-1] |= changed[1:]
            entry[last] = -1
            again = np.flatnonzero(changed & ~last)
            entry[again] = self.find(sym[again], sym[again + 1])
        if not done:
            return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        order = np.argsort(np.concatenate([w for w, _, _ in done]))
        sizes = np.concatenate([s for _, s, _ in done])
        flat, size = ragged_take(np.concatenate([x for _, _, x in done]), np.append(0, np.cumsum(sizes)), order)
        return flat, np.append(0, np.cumsum(size))

    def heap(self, sym: list[int]) -> list[int]:
        """The merges of one word, one by one."""
        n, none = len(sym), (0, -1)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(self.pairs[p][0], i, *p) for i, p in enumerate(zip(sym, sym[1:])) if p in self.pairs]
        heapify(queue)
        while queue:
            _, i, left, right = heappop(queue)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue  # one of the two was merged since
            sym[i], sym[j] = self.pairs[left, right][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for at, to in ((before[i], i), (i, after[i])):
                if at >= 0 and to < n:
                    rank, made = self.pairs.get((sym[at], sym[to]), none)
                    if made >= 0:
                        heappush(queue, (rank, at, sym[at], sym[to]))
        return [s for s in sym if s >= 0]
