"""Adding a slice without redoing the old ones: deduplication against a stored clean table, and bucketed
storage for a join that is repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import dedup
from ..session import scratch_path
from ..sources.slices import read_slices, write_slices

RANGE = "key_range"


def range_bounds(df: DataFrame, key: str, ranges: int) -> list:
    """Ascending bounds that deal the values of ``key`` into ``ranges`` parts of about equal rows."""
    probs = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, probs, 10_000)).first()[0] if probs else []
    return sorted(set(found or []))


def range_of(key: str, bounds: Sequence) -> Column:
    """The number of bounds below or at the key's value (0 for a null key)."""
    return F.coalesce(sum((F.col(key) >= F.lit(b)).cast("int") for b in bounds) if bounds else F.lit(0), F.lit(0)).alias(RANGE)


def start_clean_table(df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str] = (), ranges: int = 64) -> list:
    """The deduplicated table, stored by ranges of the first key. Returns the ranges' bounds, which ``add_slice``
    needs (keep them with the table)."""
    bounds = range_bounds(df, keys[0], ranges)
    write_slices(dedup(df, keys, order_by).withColumn(RANGE, range_of(keys[0], bounds)), path, RANGE)
    return bounds


def add_slice(new: DataFrame, path: str, keys: Sequence[str], bounds: Sequence, order_by: Sequence[str] = ()) -> list[int]:
    """Deduplicate a new slice against the table at ``path``, which then holds the rows that a full run over all
    slices would give. Only the ranges that hold keys of the slice are read (partition pruning) and replaced;
    inside them the old rows without a key of the slice are carried over by an anti join (Spark plans its Bloom
    filter from the smaller side where that pays), and only those with one are compared. Returns the ranges touched."""
    spark = new.sparkSession
    staged = scratch_path(spark, "new-survivors")
    dedup(new, keys, order_by).withColumn(RANGE, range_of(keys[0], bounds)).write.parquet(staged)
    arrived = spark.read.parquet(staged)
    touched = sorted(r[0] for r in arrived.select(RANGE).distinct().collect())  # at most one number a range
    if not touched:
        return []
    old = read_slices(spark, path).filter(F.col(RANGE).isin(touched)).select(*arrived.columns)
    have = arrived.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
    met = dedup(old.join(have, same, "left_semi").unionByName(arrived), keys, [RANGE, *order_by])
    merged = scratch_path(spark, "merged-ranges")
    old.join(have, same, "left_anti").unionByName(met.select(*old.columns)).write.parquet(merged)  # the old ranges are read before they are replaced
    write_slices(spark.read.parquet(merged), path, RANGE)
    return touched


def store_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table of the session's catalogue, dealt and sorted by ``key``: joins of two tables stored with
    one number of buckets need no shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def integrate_stored(spark: SparkSession, casualty: str, collision: str, key: str) -> DataFrame:
    """The integrate join of two stored tables."""
    return spark.table(casualty).join(spark.table(collision), on=key, how="inner")
