"""Hard negatives by slots: the upper limits of an anchor's positives split the score line.

A row is (id, label, vector); its components are whole numbers. For an anchor, its positives are the
first rows of its own label by score (ties by smaller id, null ids last), the row itself left out. For
each positive, the negatives are the first rows of other labels whose score lies between ``low`` and
``high`` parts of the positive's score. These windows overlap, and one row may serve many of them.

* The distinct upper limits cut the scores into disjoint slots, one for each limit: a row falls in the
  slot of the least limit that is not below its score.
* A task goes over its rows in tiles of ``TILE`` rows and as many anchors; products of whole numbers are
  matrix products in doubles where these are exact and in Python's whole numbers where not. It keeps the
  top rows of each anchor and slot, so a task emits at most that many, however many rows it has read.
* A window ranked over (anchor, slot) merges the tasks' tops; Spark cuts each partition's groups to their
  first rows before it shuffles them.
* A limit's answer is the merge of its slot and all lower ones in descending order. Slots are disjoint, so
  this is their concatenation, cut to the first rows and then at the window's lower end.

Rows never move for the search. Anchors go round in blocks of about ``ANCHORS`` (by a hash of the row, so
the number of blocks alone grows with the data); one block is sent to all tasks, its positives come back as
a few numbers an anchor, and the block's result is written to the shared folder before the next block.
A block costs a row of d numbers ``ANCHORS`` * d products, so the scan is bound by arithmetic, not by reading.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; a
vector shorter than another counts as zeros in the rest; components and scores beyond a long are limited to
its range (components to 2^62); rows with one id are rows of their own, as anchors too; a positive without negatives has no rows;
positives with a negative score have an empty window; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sevlab.llm.common import written
from sevlab.session import scratch_path

ANCHORS = 16_384
TILE = 2048
_LONG = np.iinfo(np.int64)
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_rows(df: DataFrame, row_id: Column, label: Column, vector: Column, scale: int = 256) -> DataFrame:
    """(rid, vec_id, label, v) of the rows that take part; ``rid`` tells rows with one id apart. Each
    component becomes floor(scale * x)."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(row_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("v"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    limit = float(1 << 62)
    whole = F.transform("v", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-limit)), F.lit(limit))).cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", whole.alias("v"))


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of vectors, filled with zeros to one width."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b`` as whole numbers."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    big_a, big_b = (np.abs(x.astype(np.float64)).max(axis=1, initial=0) for x in (a, b))
    if big_a.max(initial=0) * big_b.max(initial=0) * d < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    huge_a, huge_b = big_a * d >= 2.0**26, big_b >= 2.0**26
    for x in (False, True):
        for y in (False, True):
            rows, columns = np.flatnonzero(huge_a == x), np.flatnonzero(huge_b == y)
            if len(rows) and len(columns):
                if x or y:
                    part = np.clip(a[rows].astype(object) @ b[columns].T.astype(object), _LONG.min, _LONG.max) if d else 0
                else:
                    part = a[rows].astype(np.float64) @ b[columns].T.astype(np.float64)
                out[np.ix_(rows, columns)] = np.asarray(part).astype(np.int64)
    return out


class Block:
    """Anchors of one block: ids, labels, vectors and, per anchor, limits in descending order (the rest of the
    row repeats the last) and the least score that any window takes. Without limits one slot takes all scores."""

    def __init__(self, anchors: pa.Table, limits: np.ndarray | None = None, floor: np.ndarray | None = None):
        anchors = anchors.combine_chunks()
        self.rid = anchors["rid"].to_numpy()
        self.label = anchors["label"].to_numpy()
        self.v = _matrix(pa.concat_arrays(anchors["v"].chunks) if anchors["v"].num_chunks else pa.array([], pa.list_(pa.int64())))
        self.limits, self.floor = limits, floor

    def __len__(self) -> int:
        return len(self.rid)


class Tops:
    """The first ``k`` (score descending, id ascending, nulls last) of each anchor and slot."""

    def __init__(self, k: int):
        self.k = k
        self.group = self.score = self.vec_id = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, no_id: np.ndarray) -> None:
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        vec_id, no_id = np.concatenate([self.vec_id, vec_id]), np.concatenate([self.no_id, no_id])
        # descending scores: the complement of a long keeps its range, the negative does not
        order = np.lexsort((vec_id, no_id, ~score, group))
        group = group[order]
        first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
        place = np.arange(len(group))
        kept = place - np.maximum.accumulate(np.where(first, place, 0)) < self.k
        order = order[kept]
        self.group, self.score, self.vec_id, self.no_id = group[kept], score[order], vec_id[order], no_id[order]

    def least(self, n: int) -> np.ndarray:
        """Per group of the first ``n``: the score that a row must reach to be among the first ``k``."""
        out = np.full(n, _LONG.min)
        last = np.flatnonzero(np.concatenate([self.group[1:] != self.group[:-1], [True]])) if len(self.group) else np.zeros(0, np.int64)
        full = last[np.diff(last, prepend=-1) >= self.k]
        out[self.group[full]] = self.score[full]
        return out


def scan(batches: Iterable[pa.RecordBatch], block: Block, same_label: bool, k: int) -> Iterator[pa.RecordBatch]:
    """The tops of one task's rows: (anchor, slot, score, vec_id), ``anchor`` a place in the block."""
    slots = 1 if block.limits is None else block.limits.shape[1]
    tops = Tops(k)
    for batch in batches:
        for start in range(0, len(batch), TILE):
            part = batch.slice(start, TILE)
            rid, label = part.column("rid").to_numpy(), part.column("label").to_numpy()
            no_id = part.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            vec_id = part.column("vec_id").fill_null(0).to_numpy()
            rows = _matrix(part.column("v"), block.v.shape[1])
            least = tops.least(len(block) * slots).reshape(len(block), slots)
            for first in range(0, len(block), TILE):
                of = slice(first, first + TILE)
                score = _products(block.v[of], rows)
                allowed = (block.label[of, None] == label) == same_label
                if same_label:
                    allowed &= block.rid[of, None] != rid
                if block.limits is None:
                    allowed &= score >= least[of]
                else:
                    allowed &= (score <= block.limits[of, :1]) & (score >= block.floor[of, None])
                anchor, row = np.nonzero(allowed)
                found = score[anchor, row]
                anchor = anchor + first
                slot = np.zeros(len(anchor), np.int64)
                for i in range(1, slots):
                    slot += found <= block.limits[anchor, i]
                if slots > 1:  # equal limits are one slot: the last of them
                    near = found >= least[anchor, slot]
                    anchor, row, found, slot = anchor[near], row[near], found[near], slot[near]
                tops.add(anchor * slots + slot, found, vec_id[row], no_id[row])
    ids = pa.array(tops.vec_id, pa.int64(), mask=tops.no_id)
    yield pa.RecordBatch.from_arrays([pa.array(tops.group // slots), pa.array(tops.group % slots), pa.array(tops.score), ids], ["anchor", "slot", "score", "vec_id"])


def _ranked(rows: DataFrame, sent: Broadcast, same_label: bool, k: int) -> DataFrame:
    """(anchor, slot, r, score, vec_id): the first ``k`` of each anchor and slot over all rows."""
    tops = rows.mapInArrow(lambda batches: scan(batches, sent.value, same_label, k), "anchor long, slot long, score long, vec_id long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return tops.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)


def _limits(n: int, k: int, positives: pa.Table, low: int, high: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor: the distinct upper limits of its positives, descending, and the least score in a window."""
    limits, floor = np.full((n, k), _LONG.min), np.full(n, _LONG.max)
    used = np.zeros(n, np.int64)
    for anchor, score in zip(positives["anchor"].to_pylist(), positives["score"].to_pylist()):
        upper, lower = high * score // parts, -(-low * score // parts)
        if lower <= upper:
            floor[anchor] = min(int(floor[anchor]), max(lower, _LONG.min))
            if not used[anchor] or limits[anchor, used[anchor] - 1] != upper:
                limits[anchor, used[anchor]:] = min(upper, _LONG.max)
                used[anchor] += 1
    return limits, floor


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, parts: int = 100) -> DataFrame:
    """``RESULT`` rows for (rid, vec_id, label, v) rows, as ``whole_rows`` makes them: for each anchor and
    positive the first ``negatives`` rows of another label with ``low`` * positive <= ``parts`` * negative <= ``high`` * positive."""
    spark = vectors.sparkSession
    rows = written(vectors, "vectors")
    anchors = written(rows.filter(is_anchor), "anchors")
    n_blocks = -(-anchors.count() // ANCHORS)
    path = scratch_path(spark, "negatives")
    if not n_blocks:
        return spark.createDataFrame([], RESULT)
    for b in range(n_blocks):
        one = anchors.filter(F.pmod(F.xxhash64("rid"), F.lit(n_blocks)) == b).toArrow()  # about ANCHORS rows
        if len(one):
            _mine_block(rows, one, positives, negatives, (low, high, parts), f"{path}/block={b}")
    return spark.read.schema(RESULT).parquet(f"{path}/block=*")


def _mine_block(rows: DataFrame, anchors: pa.Table, n_positives: int, n_negatives: int, window: tuple[int, int, int], path: str) -> None:
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(Block(anchors))
    found = written(_ranked(rows, sent, True, n_positives), "positives")
    sent.destroy()
    best = found.orderBy("anchor", "r").toArrow()  # n_positives rows an anchor
    sent = spark.sparkContext.broadcast(Block(anchors, *_limits(len(anchors), n_positives, best, *window)))
    low, high, parts = window
    per_slot = _ranked(rows, sent, False, n_negatives)
    # a slot's number counts the limits at or above its scores: higher numbers hold lower scores
    suffixes = per_slot.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "slot", F.bitwise_not("score").alias("down"), F.col("vec_id").isNull().alias("no_id"), "vec_id", "score"))).alias("tops"))
    ids = spark.createDataFrame(pa.table({"anchor": pa.array(range(len(anchors)), pa.int64()), "anchor_id": anchors["vec_id"]}))
    score = F.col("score").cast("decimal(38,0)")
    wanted = found.select("anchor", F.col("r").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                          F.floor(score * high / parts).alias("upper"), score)
    joined = wanted.drop("score").join(suffixes, "anchor").join(ids, "anchor")
    suffix = F.slice(F.filter("tops", lambda t: t["score"] <= F.col("upper")), 1, n_negatives)
    inside = F.filter(suffix, lambda t: t["score"].cast("decimal(38,0)") * parts >= F.col("positive_score").cast("decimal(38,0)") * low)
    out = joined.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "t"))
    out.select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("negative_id"),
               "positive_score", F.col("t.score").alias("negative_score")).write.parquet(path)
    sent.destroy()


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: labels of ids divisible by 7 moved on by one, anchors with ids divisible by 100,
    5 positives, 5 negatives between 80 and 100 hundredths of the positive's score."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(whole_rows(embeddings, F.col("vec_id"), moved, F.col("embedding")), F.col("vec_id") % 100 == 0)
