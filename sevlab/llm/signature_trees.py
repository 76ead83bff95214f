"""Signature trees: which pairs of sets can reach a Jaccard threshold (numpy, inside one task).

A set of hashes is a bitmap (bit ``hash mod width``) with its size and its excess (size minus bits
set). Two sets share at most ``popcount(x & y) + min(excess_x, excess_y)`` elements. A tree over the
sets, ordered by size, holds in each node the OR of its bitmaps, its least and greatest size and its
greatest excess, so the same bound holds for all pairs below a pair of nodes. The dual traversal
starts at the roots and goes on only below node pairs that can reach the threshold. Pairs come in pieces,
so memory grows with the sets and not with the pairs (in a group of near copies, all of them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

FANOUT = 8
BITS_PER_ELEMENT = 4
LEAST_WIDTH = 64
SLICE_WORDS = 1 << 18  # of bitmaps that one step compares at once
SLICE_NODES = 1024  # node pairs whose children are taken at once


def width_of(size: int) -> int:
    """Bits of a bitmap: a power of two, the same for all sizes with the same logarithm."""
    return max(LEAST_WIDTH, BITS_PER_ELEMENT << int(size).bit_length())


def bitmap(hashes: np.ndarray) -> bytes:
    bits = np.zeros(width_of(len(hashes)), np.uint8)
    bits[hashes & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Level:
    bits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    excess: np.ndarray


def levels(bits: np.ndarray, sizes: np.ndarray) -> list[Level]:
    """The tree over sets in ascending order of size, leaves first."""
    set_bits = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    out = [Level(bits, sizes, sizes, sizes - set_bits)]
    while len(out[-1].low) > 1:
        x = out[-1]
        at = np.arange(0, len(x.low), FANOUT)
        out.append(Level(np.bitwise_or.reduceat(x.bits, at, axis=0), np.minimum.reduceat(x.low, at), np.maximum.reduceat(x.high, at), np.maximum.reduceat(x.excess, at)))
    return out


def _possible(x: Level, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs can hold sets with 100 * shared >= percent * union."""
    near = (100 * x.high[a] >= percent * x.low[b]) & (100 * x.high[b] >= percent * x.low[a])
    at = np.flatnonzero(near)
    step = max(1, SLICE_WORDS // x.bits.shape[1])
    for k in range(0, len(at), step):
        i, j = a[at[k:k + step]], b[at[k:k + step]]
        shared = np.bitwise_count(x.bits[i] & x.bits[j]).sum(axis=1).astype(np.int64) + np.minimum(x.excess[i], x.excess[j])
        near[at[k:k + step]] = (100 + percent) * shared >= percent * (x.low[i] + x.low[j])
    return near


SMALL = 32  # sets that are leaves of one root


def _below(sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of positions inside each run of ``groups`` lengths."""
    last = np.repeat(np.cumsum(groups), groups)
    each = last - np.arange(len(sizes)) - 1  # positions after each one in its run
    i = np.repeat(np.arange(len(sizes)), each)
    begin = np.cumsum(each) - each
    return i, i + 1 + np.arange(len(i)) - np.repeat(begin, each)


class Bitmaps:
    """Bitmaps of several widths, one matrix for each width."""

    def __init__(self, raw: list[bytes], sizes: np.ndarray) -> None:
        self.sizes = sizes
        self.widths = np.array([8 * len(b) for b in raw], np.int64)
        self.place = np.zeros(len(raw), np.int64)
        self.tables: dict[int, np.ndarray] = {}
        for width in np.unique(self.widths).tolist():
            at = np.flatnonzero(self.widths == width)
            self.place[at] = np.arange(len(at))
            self.tables[width] = np.frombuffer(b"".join(raw[k] for k in at), np.uint64).reshape(len(at), -1)

    def folded(self, at: np.ndarray, width: int) -> np.ndarray:
        """Rows of one width or twice as wide, ORed down to ``width`` bits."""
        out = np.empty((len(at), width // 64), np.uint64)
        same = self.widths[at] == width
        out[same] = self.tables[width][self.place[at[same]]] if same.any() else 0
        if not same.all():
            wide = self.tables[2 * width][self.place[at[~same]]]
            out[~same] = wide[:, :width // 64] | wide[:, width // 64:]
        return out

    def reach(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs of rows can reach the threshold."""
        a, b = self.sizes[i], self.sizes[j]
        good = (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        width = np.minimum(self.widths[i], self.widths[j])
        for w in np.unique(width[good]).tolist():
            pairs = np.flatnonzero(good & (width == w))
            step = max(1, SLICE_WORDS * 64 // w)
            for k in range(0, len(pairs), step):
                p = pairs[k:k + step]
                x, y = self.folded(i[p], w), self.folded(j[p], w)
                excess = np.minimum(*(self.sizes[at[p]] - np.bitwise_count(bits).sum(axis=1).astype(np.int64) for at, bits in ((i, x), (j, y))))
                shared = np.bitwise_count(x & y).sum(axis=1).astype(np.int64) + excess
                good[p] = (100 + percent) * shared >= percent * (self.sizes[i[p]] + self.sizes[j[p]])
        return good

    def pair_pieces(self, at: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (i < j) of the rows ``at`` that can reach the threshold, by the trees. Sets that
        reach it have the same width or the next one."""
        for width in np.unique(self.widths[at]).tolist():
            near = at[(self.widths[at] == width) | (self.widths[at] == 2 * width)]
            for i, j in candidates(self.folded(near, width), self.sizes[near], percent):
                use = (self.widths[near[i]] == width) | (self.widths[near[j]] == width)
                i, j = near[i[use]], near[j[use]]
                yield np.minimum(i, j), np.maximum(i, j)

    def group_pieces(self, groups: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for runs of rows of the given lengths; small groups are taken together."""
        begin = np.cumsum(groups) - groups
        small = np.flatnonzero(groups <= SMALL)
        for k in range(0, len(small), SLICE_NODES):
            some = small[k:k + SLICE_NODES]
            rows = np.repeat(begin[some] - np.cumsum(groups[some]) + groups[some], groups[some]) + np.arange(groups[some].sum())
            i, j = _below(rows, groups[some])
            i, j = rows[i], rows[j]
            good = self.reach(i, j, percent)
            yield i[good], j[good]
        for g in np.flatnonzero(groups > SMALL):
            yield from self.pair_pieces(np.arange(begin[g], begin[g] + groups[g]), percent)

    def pairs(self, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All that ``pair_pieces`` gives, for few rows."""
        return _joined(self.pair_pieces(at, percent))

    def group_pairs(self, groups: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All that ``group_pieces`` gives, for few rows."""
        return _joined(self.group_pieces(groups, percent))


def _joined(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.concatenate([np.zeros((2, 0), np.int64), *map(np.stack, pieces)], axis=1)
    return i, j


def candidates(bits: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i < j) of all pairs of sets whose bound reaches the threshold."""
    order = np.argsort(sizes, kind="stable")
    tree = levels(bits[order], sizes[order])
    child = np.arange(FANOUT)

    def below(depth: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keep = _possible(tree[depth], a, b, percent)
        a, b = a[keep], b[keep]
        if not depth:
            i, j = order[a[a != b]], order[b[a != b]]
            yield np.minimum(i, j), np.maximum(i, j)
            return
        n = len(tree[depth - 1].low)
        for k in range(0, len(a), SLICE_NODES):
            i = (a[k:k + SLICE_NODES, None, None] * FANOUT + child[None, :, None] + 0 * child[None, None, :]).ravel()
            j = (b[k:k + SLICE_NODES, None, None] * FANOUT + child[None, None, :] + 0 * child[None, :, None]).ravel()
            real = (i < n) & (j < n) & (i <= j)
            if real.any():
                yield from below(depth - 1, i[real], j[real])

    return below(len(tree) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))
