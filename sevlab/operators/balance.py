"""Class balance: counts, inverse-frequency weights, weight smoothing, attaching a table by key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import group_count

def attach(df: DataFrame, table: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Left-join ``cols`` of ``table`` (one row per ``key``) after the columns of ``df``. Spark picks the join
    from the sizes that it measures; the columns are the same at any size. A null key matches nothing."""
    other = table.select(F.col(key).alias("_attach_key"), *[F.col(c).alias(f"_attach_{c}") for c in cols])
    joined = df.join(other, df[key] == F.col("_attach_key"), "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"_attach_{c}").alias(c) for c in cols])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return group_count(df, label)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """(label, count, class_weight) with class_weight = largest class count / class count, for any
    number of classes (the null class counts towards the max, as a groupBy includes it). Only the
    max comes to the driver."""
    counts = class_counts(df, label)
    most = counts.agg(F.max("count")).first()[0] or 0
    return counts.withColumn("class_weight", F.lit(float(most)) / F.col("count"))


def attach_class_weight(df: DataFrame, label: str, weights: DataFrame | None = None,
                        out: str = "class_weight") -> DataFrame:
    """Add the class weight of each row's label (null for a label with no weight, e.g. null)."""
    w = class_weight_table(df, label) if weights is None else weights
    if out != "class_weight":
        w = w.withColumnRenamed("class_weight", out)
    return attach(df, w, label, [out])


def smoothed_weight(df: DataFrame, weight: str = "class_weight", out: str = "smoothed_weight") -> DataFrame:
    """Square-root smoothing of a weight column."""
    return df.withColumn(out, F.sqrt(F.col(weight)))
