"""Weighted random forest whose trees do not depend on the table's layout.

* Bootstrap: a row's weight in a tree is a Poisson(1) draw from a hash of (row key, tree, seed), so it is the
  same in any partition, on any rerun and after a lost executor.
* Cuts: a feature with at most ``max_bins`` values is cut between all of them, others at exact quantiles
  (from value counts). Rows are binned once into a compact table: a byte or two a feature.
* Rows alike: where rows of equal bins, class and weight are many (coded columns), they become one row with the
  sum of their draws in each tree, so a level costs what the kinds of rows do. Groups may come in pieces (a hot
  one is split), which adds up to the same sums. Other tables stay as rows.
* Levels: a pass over the binned rows makes the histograms of all open nodes of all trees. A task walks its
  rows down the trees and sums weights by (tree, node, candidate feature, bin, class) before anything is
  shuffled; histograms meet by (tree, node), and one row a node, its best cut, comes to the driver, which
  holds the forest, as Spark ML's driver does. A level costs one scan, whatever the number of rows.
* Sums are of whole numbers (weights in units of 2^-16), so their order doesn't matter; ties go to the
  lower feature, then the lower cut. Candidate features of a node are drawn by hash too.

The result is Spark ML's own ``RandomForestClassificationModel`` (written in its file format and loaded), so
scoring, saving and streaming use the JVM model. Gini impurity, binary cuts ``x <= t``, a cut must gain more
than ``MIN_GAIN``; rows with a null label, weight, key or vector take no part; NaN goes right.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .quantiles import discrete, ranked

UNIT = 1 << 16
MIN_GAIN = 1e-9
CHUNK_ROWS = 1 << 20
CHUNK_CELLS = 1 << 22
#: Rows a kind, on average, from which rows alike are put together; kinds that a task holds while it does; and the
#: draws of a kind beyond which it hands on what it has, so that weights stay exact as doubles.
ALIKE_ROWS = 2
ALIKE_KINDS = 1 << 17
ALIKE_DRAWS = 1 << 24
#: Rows walked down a tree at a time: their arrays stay in the core's cache.
BLOCK_ROWS = 1 << 14
_LEAF, _OPEN = -1, -2
# The odd constants of the splitmix64 mixing function.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def row_key(*columns: str | Column) -> Column:
    """60 bits of the md5 of the columns' text: a key that any engine can compute."""
    text = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def poisson_points() -> list[int]:
    """Points of a 32-bit draw from which the Poisson(1) count is at least 1, 2, ..."""
    points, total, k = [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        k += 1
        if int(total * 2**32) >= 2**32 - 1:
            return points
        points.append(int(total * 2**32))


@lru_cache(maxsize=1)
def _draw_tables() -> tuple[np.ndarray, np.ndarray]:
    """The points of a draw, and the count for each of its leading 16 bits, -1 where a point lies among the draws that begin so."""
    points, begin = np.array(poisson_points(), np.uint64), np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)
    first, last = (np.searchsorted(points, x, side="right") for x in (begin, begin + np.uint64(0xFFFF)))
    return points, np.where(first == last, first, -1)


def draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree."""
    salt = np.uint64((tree + 1 + (seed << 20)) * MIX[0] % 2**64)
    points, counts = _draw_tables()
    draw = mixed(key.astype(np.uint64) + salt)
    times = counts.take((draw >> np.uint64(48)).view(np.int64))
    open_ = np.flatnonzero(times < 0)
    times[open_] = np.searchsorted(points, draw[open_] >> np.uint64(32), side="right")
    return times


def candidates(nodes: np.ndarray, tree: int, seed: int, n_features: int, n: int) -> np.ndarray:
    """The ``n`` features, ascending, that each node of a tree may be cut on."""
    with np.errstate(over="ignore"):
        cell = ((np.uint64(tree) << np.uint64(40)) + (nodes.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(n_features, dtype=np.uint64))
        rank = mixed(cell + np.uint64((seed + 1) * MIX[0] % 2**64))
    return np.sort(np.argsort(rank, axis=1, kind="stable")[:, :n], axis=1)


@dataclass
class Trees:
    """All trees as arrays by (tree, node); the children of node n are 2n + 1 and 2n + 2."""
    n_trees: int
    depth: int
    n_classes: int
    seed: int
    cuts: list[np.ndarray]
    subset: int
    max_bins: int = 32
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        shape = (self.n_trees, 2 ** (self.depth + 1) - 1)
        self.feature, self.cut = np.full(shape, _LEAF, np.int16), np.zeros(shape, np.int16)
        self.gain, self.weight = np.full(shape, -1.0), np.zeros((*shape, self.n_classes), np.int64)
        self.feature[:, 0] = _OPEN

    @property
    def bins(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    def walker(self) -> "Trees":
        """What a task needs: no weights and gains."""
        out = object.__new__(Trees)
        out.__dict__ = {**self.__dict__, "weight": None, "gain": None}
        return out


def fit_cuts(rows: DataFrame, n_features: int, max_bins: int) -> list[np.ndarray]:
    """Ascending cuts of each feature of (x array) rows; at most ``max_bins`` - 1 numbers a feature come to the driver."""
    counts = rows.select(F.posexplode("x").alias("c", "v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ranks = ranked(counts.groupBy("c", F.lit(None).cast("string").alias("g"), (F.col("v") + 0.0).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    sizes = {r.c: r.n for r in ranks.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [c for c, n in sizes.items() if n <= max_bins]
    cuts = [np.zeros(0) for _ in range(n_features)]
    values: dict[int, list[float]] = {c: [] for c in few}
    for r in ranks.filter(F.col("c").isin(few)).select("c", "v").collect() if few else []:
        values[r.c].append(r.v)
    for c, found in values.items():
        v = np.sort(np.array(found))
        cuts[c] = (v[:-1] + v[1:]) / 2
    if len(few) < len(sizes):
        probs = [k / max_bins for k in range(1, max_bins)]
        for r in discrete(ranks.filter(~F.col("c").isin(few)), probs).collect():
            cuts[r.c] = np.unique(np.array(r.q))
    return cuts


def _binned(batches: Iterable[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    kind = np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(kind)
        width = bins.itemsize * bins.shape[1]
        offsets = pa.py_buffer(np.arange(0, (len(batch) + 1) * width, max(width, 1), dtype=np.int32)[:len(batch) + 1])
        packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, offsets, pa.py_buffer(np.ascontiguousarray(bins))])
        yield pa.RecordBatch.from_arrays([packed, batch.column("y"), batch.column("w"), batch.column("k")], ["bins", "y", "w", "k"])


def _joined(column: pa.Array) -> memoryview:
    """The bytes of all values of a binary column without nulls, as they lie in its buffer."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = int(ends[column.offset]), int(ends[column.offset + len(column)])
    return memoryview(data)[first:last] if data is not None else memoryview(b"")


def _rows(batches: Iterable[pa.RecordBatch], n_features: int, wide: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Chunks of (bins, class, weight, key), of rows alike (bins, class, weight, draws by tree)."""
    held: list[tuple[np.ndarray, ...]] = []
    most = CHUNK_ROWS

    def chunk():
        return tuple(np.concatenate(part) for part in zip(*held))

    for batch in batches:
        if len(batch):
            bins = np.frombuffer(_joined(batch.column("bins")), np.uint16 if wide else np.uint8).reshape(len(batch), n_features)
            if "times" in batch.schema.names:
                most = max(1, CHUNK_ROWS // 4)
                last = np.frombuffer(_joined(batch.column("times")), np.uint32).reshape(len(batch), -1)
            else:
                last = batch.column("k").to_numpy()
            held.append((bins, batch.column("y").to_numpy(), batch.column("w").to_numpy(), last))
        if sum(len(h[1]) for h in held) >= most:
            yield chunk()
            held = []
    if held:
        yield chunk()


def _words(bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each row's bins, class and weight as whole 64-bit words."""
    width = bins.shape[1] * bins.itemsize
    words = np.zeros((len(bins), -(-width // 8) + 2), np.uint64)
    words.view(np.uint8)[:, :width] = np.ascontiguousarray(bins).view(np.uint8).reshape(len(bins), width)
    words[:, -2], words[:, -1] = y.astype(np.uint64), w.astype(np.uint64)
    return words


def _hashed(words: np.ndarray) -> np.ndarray:
    hashed = np.zeros(len(words), np.uint64)
    for column in words.T:
        hashed = mixed((hashed ^ column) + np.uint64(MIX[0]))
    return hashed


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings rows alike together, and where each run of them starts. Rows are told apart by all words;
    a collision of their hashes only makes more runs."""
    order = np.argsort(_hashed(words), kind="stable")
    ordered = words[order]
    return order, np.flatnonzero(np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1)))


def alike(batches: Iterable[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    """Rows of equal bins, class and weight as one, with the sum of their draws in each tree."""
    n_features, wide = len(trees.cuts), trees.bins > 256
    width = n_features * (2 if wide else 1)

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        words, times = (np.concatenate(part) for part in zip(*held))
        order, starts = _runs(words)
        return words[order[starts]], np.add.reduceat(times[order], starts, axis=0, dtype=np.uint32)

    def fixed(values: np.ndarray, size: int) -> pa.Array:
        offsets = pa.py_buffer((np.arange(len(values) + 1) * size).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(values), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])

    def out(words: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(words), BLOCK_ROWS):
            part = words[start:start + BLOCK_ROWS]
            bins = np.ascontiguousarray(part).view(np.uint8)[:, :width]
            yield pa.RecordBatch.from_arrays([fixed(bins, width), pa.array(part[:, -2].astype(np.int32)), pa.array(part[:, -1].astype(np.int64)),
                                              fixed(times[start:start + BLOCK_ROWS], 4 * trees.n_trees)], ["bins", "y", "w", "times"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for bins, y, w, key in _rows(batches, n_features, wide):
        for start in range(0, len(y), max(1, CHUNK_ROWS // 4)):
            b = slice(start, start + max(1, CHUNK_ROWS // 4))
            words = _words(bins[b], y[b], w[b])
            order, starts = _runs(words)
            ordered, times = key[b][order], np.empty((len(starts), trees.n_trees), np.uint32)
            for tree in range(trees.n_trees):
                times[:, tree] = np.add.reduceat(draws(ordered, tree, trees.seed), starts)
            held.append((words[order[starts]], times))
            if sum(len(h[0]) for h in held) > ALIKE_KINDS or times.max() > ALIKE_DRAWS:
                held = [merged(held)]
            if len(held[0][0]) > ALIKE_KINDS or held[0][1].max() > ALIKE_DRAWS:
                yield from out(*held.pop(0))
    if held:
        yield from out(*merged(held))


def _cells(x: np.ndarray, y: np.ndarray, w: np.ndarray, times: np.ndarray, trees: Trees, tree: int, level: int,
           number: np.ndarray, options: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (open node, candidate, bin, class) that a block of rows adds to at a level of a tree, and the weights added.
    ``number``: of each node of the level, -1 unless it is open; ``options``: candidates by (place, open node)."""
    feature, cut, bins = trees.feature[tree].astype(np.int64), trees.cut[tree], x.ravel()
    row = np.flatnonzero(times != 0)
    begin, node = row * x.shape[1], np.zeros(len(row), np.int64)
    for step in range(level):
        wanted = feature.take(node)
        if step % 3 == 2:  # rows in leaves leave; until then they go on to nodes that no tree has
            inner = wanted >= 0
            if not inner.all():
                row, begin, node, wanted = row[inner], begin[inner], node[inner], wanted[inner]
        right = bins.take(begin + np.maximum(wanted, 0)) > cut.take(node)
        node += node
        node += 1
        node += right
    node = number.take(node - (2**level - 1))
    inside = np.flatnonzero(node >= 0)
    row, begin, node = row[inside], begin[inside], node[inside]
    size = trees.bins * trees.n_classes
    here = node * (len(options) * size) + y[row]
    cells = np.empty((len(options), len(row)), np.int64)
    for s, option in enumerate(options):
        np.multiply(bins.take(begin + option.take(node)), trees.n_classes, out=cells[s], casting="unsafe", dtype=np.int64)
        cells[s] += here + s * size
    return cells.ravel(), np.tile((w[row] * times[row].astype(np.int64)).astype(np.float64), len(options))


def _added(cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of whole weights by cell: as doubles while these are exact."""
    if weights.sum() <= 2.0**53:
        return np.bincount(cells, weights=weights).astype(np.int64)
    sums = np.zeros(int(cells.max()) + 1, np.int64)
    np.add.at(sums, cells, weights.astype(np.int64))
    return sums


def histograms(batches: Iterable[pa.RecordBatch], trees: Trees, level: int) -> Iterator[pa.RecordBatch]:
    """Per chunk of rows, tree and open node of the level: the cells (candidate, bin, class) with their weights."""
    n_features, n_classes, bins = len(trees.cuts), trees.n_classes, trees.bins
    per_node = trees.subset * bins * n_classes
    first = 2**level - 1
    for x, y, w, key in _rows(batches, n_features, bins > 256):
        drawn = np.ascontiguousarray(key.T) if key.ndim == 2 else None
        blocks = [slice(start, start + BLOCK_ROWS) for start in range(0, len(y), BLOCK_ROWS)]
        of_chunk, weight_of = np.empty(len(y) * trees.subset, np.int64), np.empty(len(y) * trees.subset)
        for tree in range(trees.n_trees):
            at_level = trees.feature[tree, first:2 * first + 1]
            nodes = np.flatnonzero(at_level == _OPEN)
            if not len(nodes):
                continue
            number = np.full(len(at_level), -1, np.int64)
            number[nodes] = np.arange(len(nodes))
            options = np.ascontiguousarray(candidates(nodes + first, tree, trees.seed, n_features, trees.subset).T)
            end = 0
            for b in blocks:
                times = draws(key[b], tree, trees.seed) if drawn is None else drawn[tree, b]
                found, added = _cells(x[b], y[b], w[b], times, trees, tree, level, number, options)
                start, end = end, end + len(found)
                of_chunk[start:end], weight_of[start:end] = found, added
            if not end:
                continue
            cell, weights = of_chunk[:end], weight_of[:end]
            if len(nodes) * per_node <= CHUNK_CELLS:
                sums = _added(cell, weights)
                used = np.flatnonzero(sums)
                sums = sums[used]
            else:
                used, place = np.unique(cell, return_inverse=True)
                sums = _added(place, weights)
            of_node = used // per_node
            here, starts = np.unique(of_node, return_index=True)
            offsets = pa.array(np.append(starts, len(used)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(here), tree, np.int32)), pa.array((nodes[here] + first).astype(np.int32)),
                 pa.ListArray.from_arrays(offsets, pa.array((used % per_node).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(sums))], ["tree", "node", "cells", "sums"])


def _best(weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of (node, candidate, bin, class) weights: candidate, bin and gain of the best cut, its left weights and all."""
    upto = np.cumsum(weights, axis=2)
    total = upto[:, 0, -1, :]
    left = upto[:, :, :-1, :]
    right = total[:, None, None, :] - left

    def purity(x: np.ndarray) -> np.ndarray:
        """Sum of squared class weights over the weight; 0 where there is none."""
        x = x.astype(np.float64)
        n = x.sum(axis=-1)
        return np.divide((x * x).sum(axis=-1), n, out=np.zeros_like(n), where=n > 0)

    whole = total.sum(axis=-1).astype(np.float64)
    gain = (purity(left) + purity(right) - purity(total)[:, None, None]) / whole[:, None, None]
    gain[(left.sum(axis=-1) == 0) | (right.sum(axis=-1) == 0)] = -1.0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1) if flat.shape[1] else np.zeros(len(flat), np.int64)
    rows = np.arange(len(gain))
    width = max(left.shape[2], 1)
    slot, cut = best // width, best % width
    if not flat.shape[1]:
        return slot, cut, np.full(len(rows), -1.0), total * 0, total
    return slot, cut, flat[rows, best], left[rows, slot, cut], total


CUT_SCHEMA = "tree int, node int, feature int, cut int, gain double, left array<long>, total array<long>"


def best_cuts(batches: Iterable[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    """The best cut of each (tree, node) of rows sorted by them."""
    per_node = trees.subset * trees.bins * trees.n_classes
    held: list[tuple[np.ndarray, ...]] = []

    def lists(values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, trees.n_classes), pa.int32()), pa.array(np.ascontiguousarray(values).ravel()))

    def finish(tree: np.ndarray, node: np.ndarray, size: np.ndarray, cells: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = (tree.astype(np.int64) << 32) | node
        keys, number = np.unique(key, return_inverse=True)
        number = np.repeat(number, size)
        most = max(1, CHUNK_CELLS // per_node)
        for start in range(0, len(keys), most):
            part = keys[start:start + most]
            inside = (number >= start) & (number < start + len(part))
            weights = np.zeros(len(part) * per_node, np.int64)
            np.add.at(weights, (number[inside] - start) * per_node + cells[inside], sums[inside])
            slot, cut, gain, left, total = _best(weights.reshape(len(part), trees.subset, trees.bins, trees.n_classes))
            of_tree, of_node = (part >> 32).astype(np.int32), (part & 0xFFFFFFFF).astype(np.int32)
            feature = np.zeros(len(part), np.int32)
            for t in np.unique(of_tree):
                of = of_tree == t
                feature[of] = candidates(of_node[of], int(t), trees.seed, len(trees.cuts), trees.subset)[np.arange(of.sum()), slot[of]]
            feature[gain <= MIN_GAIN] = _LEAF
            yield pa.RecordBatch.from_arrays([pa.array(of_tree), pa.array(of_node), pa.array(feature), pa.array(cut.astype(np.int32)), pa.array(gain), lists(left), lists(total)],
                                             ["tree", "node", "feature", "cut", "gain", "left", "total"])

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(part) for part in zip(*held))

    for batch in batches:
        if not len(batch):
            continue
        cells, sums = batch.column("cells"), batch.column("sums")
        held.append((batch.column("tree").to_numpy(), batch.column("node").to_numpy(), cells.value_lengths().to_numpy(), cells.flatten().to_numpy(), sums.flatten().to_numpy()))
        if sum(len(h[3]) for h in held) >= CHUNK_CELLS:
            tree, node, size, c, s = joined()
            other = np.flatnonzero((tree != tree[-1]) | (node != node[-1]))
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                split = int(size[:last].sum())
                yield from finish(tree[:last], node[:last], size[:last], c[:split], s[:split])
                held = [(tree[last:], node[last:], size[last:], c[split:], s[split:])]
            else:  # one node has filled the chunk: its sums so far become one row
                u, place = np.unique(c, return_inverse=True)
                merged = np.zeros(len(u), np.int64)
                np.add.at(merged, place, s)
                held = [(tree[:1], node[:1], np.array([len(u)]), u, merged)]
    if held:
        yield from finish(*joined())


def _few_kinds(n: int, kinds: int) -> bool:
    return n >= ALIKE_ROWS * kinds


def _written(table: DataFrame, name: str) -> DataFrame:
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def _compact(binned: DataFrame, trees: Trees, few: bool) -> DataFrame:
    """The binned rows as a table, those alike as one where that makes far fewer: ``few`` if that is known of the
    rows before they were binned, else the written rows are counted."""
    kind = [F.col(c) for c in ("bins", "y", "w")]
    if not few:
        binned = _written(binned, "forest-rows")
        if not _few_kinds(*binned.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*kind))).first()):
            return binned
    walker = trees.walker()
    return _written(binned.hint("rebalance", *kind).mapInArrow(lambda batches: alike(batches, walker), "bins binary, y int, w bigint, times binary"), "forest-kinds")


def _grow(binned: DataFrame, trees: Trees) -> None:
    spark = binned.sparkSession
    for level in range(trees.depth + 1):
        first = 2**level - 1
        if not (trees.feature[:, first:2 * first + 1] == _OPEN).any():
            break
        sent = spark.sparkContext.broadcast(trees.walker())
        sums = binned.mapInArrow(lambda batches, level=level, sent=sent: histograms(batches, sent.value, level), "tree int, node int, cells array<int>, sums array<long>")
        merged = sums.repartition("tree", "node").sortWithinPartitions("tree", "node")
        found = merged.mapInArrow(lambda batches, sent=sent: best_cuts(batches, sent.value), CUT_SCHEMA).toArrow()
        sent.destroy()
        trees.feature[:, first:2 * first + 1][trees.feature[:, first:2 * first + 1] == _OPEN] = _LEAF
        if not len(found):
            break
        column = {c: found[c].combine_chunks() for c in found.column_names}
        tree, node, feature, cut, gain = (column[c].to_numpy() for c in ("tree", "node", "feature", "cut", "gain"))
        left, total = (column[c].flatten().to_numpy().reshape(-1, trees.n_classes) for c in ("left", "total"))
        trees.weight[tree, node] = total
        if level == trees.depth:
            break
        at = feature >= 0
        tree, node, left, right = tree[at], node[at], left[at], (total - left)[at]
        trees.feature[tree, node], trees.cut[tree, node], trees.gain[tree, node] = feature[at], cut[at], gain[at]
        for child, weight in ((2 * node + 1, left), (2 * node + 2, right)):
            trees.weight[tree, child] = weight
            more = ((weight > 0).sum(axis=1) > 1) & (level + 1 < trees.depth)
            trees.feature[tree[more], child[more]] = _OPEN


def grow(train: DataFrame, label: str, weight: str | None, key: str, features: str, params: Mapping) -> Trees:
    """The trees for rows with a vector, a whole-number label, a weight and a key."""
    unknown = set(params) - {"numTrees", "maxDepth", "maxBins", "seed", "featureSubset"}
    if unknown:
        raise ValueError(f"the forest by row hash does not know {sorted(unknown)}")
    ship_package(train.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = train.filter(F.col(features).isNotNull()).select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("int").alias("y"), F.round(w * UNIT).cast("bigint").alias("w"), F.col(key).cast("bigint").alias("k")).dropna()
    facts = rows.agg(F.max(F.size("x")).alias("n"), F.max("y").alias("y"), F.min("y").alias("least"), F.min("w").alias("w"),
                     F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64("x", "y", "w")).alias("kinds")).first()
    if facts.n is None or facts.least < 0 or facts.w < 0:
        raise ValueError("no rows to train on, or a negative label or weight")
    n_features = facts.n
    cuts = fit_cuts(rows, n_features, int(params.get("maxBins", 32)))
    binned = rows.mapInArrow(lambda batches: _binned(batches, cuts), "bins binary, y int, w bigint, k bigint")
    subset = int(params.get("featureSubset", math.ceil(math.sqrt(n_features))))
    trees = Trees(int(params.get("numTrees", 20)), int(params.get("maxDepth", 5)), facts.y + 1, int(params.get("seed", 0)), cuts, subset, int(params.get("maxBins", 32)))
    _grow(_compact(binned, trees, _few_kinds(facts.rows, facts.kinds)), trees)
    return trees


def node_table(spark: SparkSession, trees: Trees) -> DataFrame:
    """(tree, node, feature, threshold, weights): one row a node; leaves have no feature and threshold."""
    tree, node = np.nonzero(trees.weight.sum(axis=2))
    feature = trees.feature[tree, node]
    inner = feature >= 0
    threshold = np.array([trees.cuts[f][c] if f >= 0 else np.nan for f, c in zip(feature, trees.cut[tree, node])])
    weights = trees.weight[tree, node] / UNIT
    return spark.createDataFrame(pa.table({
        "tree": pa.array(tree.astype(np.int32)), "node": pa.array(node.astype(np.int32)), "feature": pa.array(feature.astype(np.int32), mask=~inner),
        "threshold": pa.array(threshold, mask=~inner), "weights": pa.ListArray.from_arrays(np.arange(0, weights.size + 1, trees.n_classes, dtype=np.int32), weights.ravel())}))


def _stored_nodes(trees: Trees) -> pa.Table:
    """All nodes as Spark ML numbers and stores them: a node, its left branch, its right branch."""
    inner, n = trees.feature >= 0, trees.feature.shape[1]
    size = np.ones((trees.n_trees, 2 * n + 1), np.int64)
    for level in range(trees.depth, -1, -1):
        node = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        size[:, node] += np.where(inner[:, node], size[:, 2 * node + 1] + size[:, 2 * node + 2], 0)
    place = np.full((trees.n_trees, 2 * n + 1), -1, np.int64)
    place[:, 0] = 0
    for level in range(trees.depth):
        tree, node = np.nonzero(inner[:, 2**level - 1:2 ** (level + 1) - 1] & (place[:, 2**level - 1:2 ** (level + 1) - 1] >= 0))
        node = node + 2**level - 1
        place[tree, 2 * node + 1] = place[tree, node] + 1
        place[tree, 2 * node + 2] = place[tree, node] + 1 + size[tree, 2 * node + 1]
    tree, node = np.nonzero(place[:, :n] >= 0)
    weights, cut_here = trees.weight[tree, node], inner[tree, node]
    total = weights.sum(axis=1).astype(np.float64)
    share = np.divide(weights, total[:, None], out=np.zeros(weights.shape), where=total[:, None] > 0)
    feature = np.where(cut_here, trees.feature[tree, node], -1)
    width = trees.bins
    cuts = np.zeros((len(trees.cuts), width))
    for i, c in enumerate(trees.cuts):
        cuts[i, :len(c)] = c
    thresholds = cuts[feature, trees.cut[tree, node]][cut_here]

    def ints(x: np.ndarray) -> pa.Array:
        return pa.array(x.astype(np.int32))

    split = pa.StructArray.from_arrays([ints(feature), pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(cut_here)]).astype(np.int32), thresholds), ints(np.full(len(node), -1))],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = pa.ListArray.from_arrays(np.arange(0, weights.size + 1, trees.n_classes, dtype=np.int32), (weights / UNIT).ravel())
    stored = pa.StructArray.from_arrays(
        [ints(place[tree, node]), pa.array(weights.argmax(axis=1).astype(np.float64)), pa.array(np.where(total > 0, 1.0 - (share * share).sum(axis=1), 0.0)), stats,
         pa.array(np.round(total / UNIT).astype(np.int64)), pa.array(np.where(cut_here, trees.gain[tree, node], -1.0)),
         ints(np.where(cut_here, place[tree, 2 * node + 1], -1)), ints(np.where(cut_here, place[tree, 2 * node + 2], -1)), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": ints(tree), "nodeData": stored})


def write_model(spark: SparkSession, trees: Trees, path: str, label: str, features: str, weight: str | None) -> str:
    """The forest in Spark ML's own file format."""
    schema = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
              "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")
    common = {"featuresCol": features, "labelCol": label, "maxDepth": trees.depth, "seed": trees.seed, "maxBins": trees.max_bins} | ({"weightCol": weight} if weight else {})
    defaults = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "leafCol": "",
                "impurity": "gini", "cacheNodeIds": False, "checkpointInterval": 10, "maxBins": 32, "maxDepth": 5, "maxMemoryInMB": 256, "minInfoGain": 0.0,
                "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "seed": 0}
    forest_defaults = {"bootstrap": True, "featureSubsetStrategy": "auto", "numTrees": 20, "subsamplingRate": 1.0}

    def metadata(kind: str, uid: str, own: dict, default: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                           "paramMap": own, "defaultParamMap": default, **more})

    n, tag = trees.n_trees, uuid.uuid4().hex[:12]
    spark.createDataFrame(_stored_nodes(trees), schema).write.mode("overwrite").parquet(f"{path}/data")
    each = [(tree, metadata("DecisionTreeClassificationModel", f"dtc_{tag}{tree}", common, defaults, numFeatures=len(trees.cuts), numClasses=trees.n_classes), 1.0) for tree in range(n)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(f"{path}/treesMetadata")
    whole = metadata("RandomForestClassificationModel", f"RandomForestClassifier_{tag}", common | {"numTrees": n}, defaults | forest_defaults,
                     numFeatures=len(trees.cuts), numClasses=trees.n_classes, numTrees=n)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def fit_forest_by_hash(train: DataFrame, label: str, params: Mapping, key: str, weight: str | None = None, features: str = "features",
                       path: str | None = None) -> RandomForestClassificationModel:
    """The forest as a Spark ML model, kept at ``path`` (a scratch folder unless given)."""
    spark = train.sparkSession
    trees = grow(train, label, weight, key, features, params)
    return RandomForestClassificationModel.load(write_model(spark, trees, path or scratch_path(spark, "forest"), label, features, weight))
