"""Sampling and train/test splits."""

from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import unit_hash

HASH_BUCKETS = 1000


def with_row_id(df: DataFrame, out: str = "id") -> DataFrame:
    """Surrogate row id (``monotonically_increasing_id``): unique, stable as long as the
    input's partitioning is (apply it right after a file scan, before any shuffle)."""
    return df.withColumn(out, F.monotonically_increasing_id())


def stratified_sample(df: DataFrame, label: str, fractions: Mapping[Any, float], seed: int) -> DataFrame:
    """Bernoulli sample per class (``sampleBy``). Classes not listed (null too) get fraction 0.
    Runs inside each partition, no shuffle; the chosen rows depend on the partitioning."""
    return df.sampleBy(label, fractions={k: float(v) for k, v in fractions.items()}, seed=seed)


def _fraction_of(label: Column, fractions: Mapping[Any, float]) -> Column:
    expr = None
    for k, v in fractions.items():
        cond = label == F.lit(k)
        expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
    return F.lit(0.0) if expr is None else expr.otherwise(F.lit(0.0))


def hash_sample_condition(label: str, fractions: Mapping[Any, float], hash_cols: Sequence[str],
                          buckets: int = HASH_BUCKETS) -> Column:
    """True for rows whose md5 bucket falls below their class's fraction."""
    return unit_hash(hash_cols, buckets) < _fraction_of(F.col(label), fractions) * F.lit(buckets)


def hash_stratified_sample(df: DataFrame, label: str, fractions: Mapping[Any, float], hash_cols: Sequence[str]) -> DataFrame:
    """Deterministic per-class sample: same rows on any layout, rerun or engine."""
    return df.filter(hash_sample_condition(label, fractions, hash_cols))


def bernoulli_split(df: DataFrame, label: str, fractions: Mapping[Any, float], seed: int) -> tuple[DataFrame, DataFrame]:
    """Per-class Bernoulli split without an id or a join: one uniform draw per row (``rand``,
    seeded per partition) decides train (draw < class fraction) or test; unlisted or null
    classes go to test. ``df`` must be a plain scan of a written table: both sides draw again,
    and only a scan gives the same rows in the same order each time. ``hash_split`` has no
    such condition."""
    base = df.withColumn("_u", F.rand(seed))
    cond = F.col("_u") < _fraction_of(F.col(label), fractions)
    return base.filter(cond).drop("_u"), base.filter(~cond).drop("_u")


def hash_split(df: DataFrame, label: str, fractions: Mapping[Any, float], hash_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Train/test split as two complementary filters: no id, no join, no shuffle.
    Identical rows land on the same side, so nothing leaks from train into test."""
    cond = hash_sample_condition(label, fractions, hash_cols)
    return df.filter(cond), df.filter(~cond | cond.isNull())


def except_split(df: DataFrame, sample: DataFrame) -> DataFrame:
    """Complement by set difference (EXCEPT DISTINCT): duplicates of the complement collapse."""
    return df.subtract(sample)


def anti_join_split(df: DataFrame, sample: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Complement by left anti join on an id (null-safe on every key column)."""
    keys = [on] if isinstance(on, str) else list(on)
    s = sample.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        cond = e if cond is None else cond & e
    return df.join(s, on=cond, how="left_anti")


def persist(df: DataFrame) -> DataFrame:
    """Memory and disk; the caller unpersists."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
