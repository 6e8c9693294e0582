"""Run-length index of a block of byte strings: run-compressed Burrows-Wheeler transform with sampled run ends.

`RunIndex` sorts the suffixes of the block once, keeps only the runs of the transform with the text positions
sampled at their ends and the common prefix lengths there, and drops the suffix array. `stream` then walks the text and
gives, for every position, the length of its longest match with its neighbour in suffix order and where that match
begins: between two sampled positions both follow from the one before (the length falls by one, the place rises
by one), which is what makes the index small for repetitive text.
"""

from __future__ import annotations

import numpy as np


def _suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from 7 symbols of 9 bits; a round sorts only what is still tied."""
    n = len(codes)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(7, np.int64)])
    for k in range(7):
        key = (key << 9) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    depth = 7
    while True:
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            return order
        rows = np.flatnonzero(tied)
        at = order[rows]
        after = np.where(at + depth < n, rank[np.minimum(at + depth, n - 1)], -1) + 1
        sub = np.argsort(rank[at] * (n + 2) + after, kind="stable")
        order[rows] = at[sub]
        group, after = rank[at[sub]], after[sub]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        first[rows] = new
        rank[at[sub]] = np.maximum.accumulate(np.where(new, rows, 0))
        depth *= 2


def _common(codes: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths, up to `most`, of the suffixes at a and at b."""
    n, out = len(codes), np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for k in range(most):
        x, y = a[alive] + k, b[alive] + k
        ok = (x < n) & (y < n)
        ok[ok] = codes[x[ok]] == codes[y[ok]]
        alive = alive[ok]
        if not len(alive):
            break
        out[alive] = k + 1
    return out


class RunIndex:
    def __init__(self, strings: list[bytes], depth: int):
        """`depth`: the length at which a match counts; longer ones need not be told apart."""
        self.depth = depth
        sizes = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(sizes + 1) - sizes - 1  # a separator follows each string
        self.size = sizes
        text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8)
        codes = text.astype(np.int16) + 2  # 1 separates, 0 is beyond the text
        codes[self.start + sizes] = 1
        self.n = len(codes)
        order = _suffix_order(codes)
        bwt = np.where(order == 0, -1, codes[order - 1])  # nothing stands before the text
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))  # first rows of the runs
        self.symbols = bwt[head].astype(np.int16)
        self.lengths = np.diff(np.append(head, self.n))
        at, before = order[head[1:]], order[head[1:] - 1]  # samples: a run's first row and the row before, the last of another
        by = np.argsort(at)
        self.sample, self.neighbour = at[by], before[by]
        # a match of more than depth + the gap to the next sample is as good as a longer one
        gaps = np.diff(np.append(self.sample, self.n))
        self.match = np.minimum(_common(codes, self.sample, self.neighbour, depth + int(gaps.max(initial=0))), self.n)

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, place) of each position's match with the suffix before it; length 0: none."""
        n = self.n
        length, place = np.zeros(n, np.int64), np.arange(n)
        if len(self.sample):
            which = np.zeros(n, np.int64)
            which[self.sample] = np.arange(len(self.sample))
            which = np.maximum.accumulate(which)
            i = np.arange(n)
            passed = i - self.sample[which]
            ok = passed >= 0
            length = np.where(ok, np.maximum(self.match[which] - passed, 0), 0)
            place = np.where(ok & (length > 0), self.neighbour[which] + passed, i)
        return length, place

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(is a window start, its string starts earlier in the block) for each position."""
        length, place = self.stream()
        root = np.where(length >= self.depth, place, np.arange(self.n))
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
        where = np.zeros(self.n + 1, np.int64)
        long = self.size >= self.depth
        np.add.at(where, self.start[long], 1)
        np.add.at(where, self.start[long] + self.size[long] - self.depth + 1, -1)
        valid = np.cumsum(where[:-1]) > 0
        at = np.flatnonzero(valid)[::-1]
        least = np.empty(self.n, np.int64)
        least[root[at]] = at  # written from the right: the leftmost stays
        again = np.zeros(self.n, bool)
        again[at] = least[root[at]] < at
        return valid, again
