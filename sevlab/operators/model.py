"""Random forest: weighted fit, table scoring, weighted F1 / accuracy, confusion matrix.

A table is scored by ``transform``: a batch of rows goes down one tree after the other, its nodes held as arrays
that stay in the core's cache (Spark's model walks all trees for one row, then for the next). Neighbours with equal
features are walked once. The numbers are Spark's to the last bit: the same shares of the leaves, added in the
order of the trees.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path, ship_package
from ..sources.models import save_model

#: Rows walked down a tree at a time: their arrays stay in the core's cache.
BLOCK_ROWS = 1 << 14


# Execution settings that do not change the fitted trees: each row's node id is cached between
# levels instead of re-walking the trees (much faster for deep trees; the cache is
# checkpointed to the shared folder every 10 levels).
EXECUTION_DEFAULTS = {"cacheNodeIds": True}


def fit_forest(train: DataFrame, label: str, params: Mapping, weight: str | None = None,
               features: str = "features") -> RandomForestClassificationModel:
    """Weighted random forest (Spark ML; split statistics aggregated on the executors)."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, **{**EXECUTION_DEFAULTS, **dict(params)})
    if weight:
        rf = rf.setWeightCol(weight)
    return rf.fit(train)


@dataclass
class Walker:
    """The nodes of all trees, one tree after the other. The children of node i are ``children[2 i]`` (left) and
    ``children[2 i + 1]``; a leaf is its own child. ``share``: of each class in a node."""
    roots: np.ndarray
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray
    share: np.ndarray

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Of (row, feature) numbers: the sum over the trees of the leaves' shares, by class. NaN goes right."""
        out = np.zeros((len(x), self.share.shape[1]))
        for start in range(0, len(x), BLOCK_ROWS):
            rows = np.ascontiguousarray(x[start:start + BLOCK_ROWS])
            flat, begin = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
            for root in self.roots:
                node = np.full(len(rows), root)
                for _ in range(self.depth):
                    left = flat.take(begin + self.feature.take(node)) <= self.threshold.take(node)
                    node += node
                    node += ~left
                    node = self.children.take(node)
                out[start:start + len(rows)] += self.share.take(node, axis=0)
        return out

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Votes, probabilities and predictions of (row, feature) numbers."""
        new = np.append(True, (x.view(np.int64)[1:] != x.view(np.int64)[:-1]).any(axis=1))[:len(x)]
        raw = self.votes(x[new])
        total = _added(raw)
        probability = np.divide(raw, total, out=raw.copy(), where=total != 0)
        back = np.cumsum(new) - 1
        return raw[back], probability[back], raw.argmax(axis=1).astype(np.float64)[back]


def _added(x: np.ndarray) -> np.ndarray:
    """Sums over the columns, added from the first to the last."""
    total = np.zeros((len(x), 1))
    for column in x.T:
        total[:, 0] += column
    return total


def walker(model: RandomForestClassificationModel, spark: SparkSession) -> Walker | None:
    """The model's nodes, from a copy that it writes; None where a cut is by categories."""
    path = scratch_path(spark, "forest-nodes")
    save_model(model, path)
    found = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select("treeID", "id", "leftChild", "rightChild", "impurityStats", "split.*").toArrow()
    delete_path(spark, path)
    column = {c: found[c].combine_chunks() for c in found.column_names}
    tree, node, left, right, feature, categories = (column[c].to_numpy() for c in ("treeID", "id", "leftChild", "rightChild", "featureIndex", "numCategories"))
    order = np.lexsort((node, tree))
    inner = left[order] >= 0
    if (categories[order][inner] >= 0).any():
        return None
    roots = np.flatnonzero(np.append(True, np.diff(tree[order]) != 0))
    offset = np.repeat(roots, np.diff(np.append(roots, len(order))))
    here = np.arange(len(order))
    if (node[order] != here - offset).any():
        raise ValueError("the nodes of a stored tree are not numbered from 0 on")
    children = np.stack([np.where(inner, side[order] + offset, here) for side in (left, right)], axis=1)
    numbers = column["leftCategoriesOrThreshold"]
    starts, threshold = numbers.offsets.to_numpy()[:-1], np.zeros(len(order))
    threshold[inner] = numbers.values.to_numpy()[starts[order][inner]]
    stats = column["impurityStats"].flatten().to_numpy().reshape(len(order), -1)[order]
    total = _added(stats)
    depth, at = 0, roots
    while (at := children[at[inner[at]]].ravel()).size:
        depth += 1
    return Walker(roots, depth, np.where(inner, feature[order], 0).astype(np.int64), threshold, children.ravel().astype(np.int64),
                  np.divide(stats, total, out=np.zeros_like(stats), where=total != 0))


_SCORES = "struct<raw:array<double>,probability:array<double>,prediction:double>"


def transform(model, df: DataFrame) -> DataFrame:
    """What ``model.transform`` gives: the same columns and numbers. Models other than forests with cuts at
    numbers, and forests that are asked for more than these columns, are left to Spark."""
    wanted = model.transform(df)
    if not isinstance(model, RandomForestClassificationModel) or model.isDefined(model.thresholds) or model.getLeafCol() or len(wanted.columns) != len(df.columns) + 3:
        return wanted
    spark = df.sparkSession
    if "_sent_walker" not in model.__dict__:  # one copy a model
        ship_package(spark)
        nodes = walker(model, spark)
        model._sent_walker = None if nodes is None else spark.sparkContext.broadcast(nodes)
    sent = model._sent_walker
    if sent is None:
        return wanted

    @F.arrow_udf(_SCORES)
    def scores(x: pa.Array) -> pa.Array:
        if x.null_count or len(pa.compute.unique(x.value_lengths())) > 1:
            raise ValueError("rows without features, or with other numbers of them, cannot be scored")
        raw, probability, prediction = sent.value.scores(np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), np.float64))
        lists = [pa.ListArray.from_arrays(np.arange(0, v.size + 1, max(v.shape[1], 1), dtype=np.int32), v.ravel()) for v in (raw, probability)]
        return pa.StructArray.from_arrays([*lists, pa.array(prediction)], ["raw", "probability", "prediction"])

    columns = {model.getRawPredictionCol(): array_to_vector("_scores.raw"), model.getProbabilityCol(): array_to_vector("_scores.probability"), model.getPredictionCol(): F.col("_scores.prediction")}
    scored = df.withColumn("_scores", scores(vector_to_array(F.col(model.getFeaturesCol()))))
    return scored.select(*df.columns, *[columns[c].alias(c, metadata=wanted.schema[c].metadata) for c in wanted.columns[len(df.columns):]])


def score(model, df: DataFrame, classes: int | None = None) -> DataFrame:
    """``prediction`` plus ``p_<k>`` = probability of class k, one column per class. The vector becomes an
    array once."""
    out = transform(model, df)
    n = classes if classes is not None else model.numClasses
    arrays = out.withColumn("_probabilities", vector_to_array(F.col("probability")))
    return arrays.select(*out.columns, *[F.col("_probabilities")[k].alias(f"p_{k}") for k in range(n)])


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row (f1, accuracy): weighted F1 and accuracy, as Spark's
    ``MulticlassClassificationEvaluator`` defines them (labels = classes present in the label
    column). One pass counts the (label, prediction) pairs; all else is over these counts, for
    any number of classes."""
    p = pred.select(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("yhat"))
    pairs = p.groupBy("y", "yhat").agg(F.count(F.lit(1)).alias("n"))
    by_label = pairs.groupBy("y").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0)).alias("hits"))
    by_guess = pairs.groupBy("yhat").agg(F.sum("n").alias("predicted"))
    both = by_label.join(by_guess, F.col("y").eqNullSafe(F.col("yhat")), "left")
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.coalesce("predicted", F.lit(0)))  # = 2 p r / (p + r)
    total = F.sum("support")
    return both.agg(F.coalesce(F.try_divide(F.sum(f1 * F.col("support")), total), F.lit(0.0)).alias("f1"),
                    F.coalesce(F.try_divide(F.sum("hits"), total), F.lit(0.0)).cast("double").alias("accuracy"))
