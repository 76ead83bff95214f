"""Integrate job: raw header-CSV tables -> keep-list -> typed projection -> casualty ⋈ collision
per slice (e.g. the archive years and the provisional year) -> union by name -> parquet.

Scale: each slice join is an equi-join on the key. The collision side grows with the data,
so it is never force-broadcast: Spark plans a sort-merge join (both sides shuffled once on
the key) and AQE turns it into a broadcast at run time only when the measured side is small,
and splits skewed key partitions. Slices joined against the same collision frame reuse its
shuffle (identical exchanges are reused)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from ..operators.clean import keep_columns, typed_projection
from ..sources.files import write_parquet


def type_table(raw: DataFrame, keep: Sequence[str], typing: Mapping[str, str | Column | None],
               on_error: str = "fail") -> DataFrame:
    return typed_projection(keep_columns(raw, keep), typing, on_error)


def join_slice(casualty: DataFrame, collision: DataFrame, key: str) -> DataFrame:
    """Inner equi-join, many casualties to one collision; the key column appears once."""
    return casualty.join(collision, on=key, how="inner")


def hot_keys(df: DataFrame, key: str, min_share: float) -> list:
    """Keys holding at least ``min_share`` of the rows: one aggregation (partial counts per
    map task); at most 1/min_share keys can qualify, so the collected list is bounded."""
    from pyspark.sql import functions as F

    total = df.count()
    if not total:
        return []
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.filter(F.col("_n") >= F.lit(min_share * total)).limit(int(1 / min_share) + 1).collect()
    return [r[key] for r in rows if r[key] is not None]


def join_slice_salted(casualty: DataFrame, collision: DataFrame, key: str, hot: list, buckets: int) -> DataFrame:
    """The same inner join with hot keys salted, for sessions without AQE skew splitting:
    casualty rows of a hot key are spread over ``buckets`` salt values (by a hash of the row),
    and only the collision rows of hot keys are replicated ``buckets`` times; other keys keep
    salt 0. The join is on (key, salt), so one hot key is processed by ``buckets`` tasks."""
    from pyspark.sql import functions as F

    if not hot:
        return join_slice(casualty, collision, key)
    is_hot = F.col(key).isin(hot)
    row_hash = F.xxhash64(*[F.col(c) for c in casualty.columns])
    cas = casualty.withColumn("_salt", F.when(is_hot, F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    col = collision.withColumn("_salt", F.explode(salts))
    return cas.join(col, on=[key, "_salt"], how="inner").drop("_salt")


def union_slices(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def integrate(slices: Sequence[tuple[DataFrame, DataFrame]], key: str, salt_share: float | None = None,
              salt_buckets: int = 64) -> DataFrame:
    """``slices``: (typed casualty, typed collision) pairs; each pair joined, all unioned.
    ``salt_share``: salt keys holding at least that share of a slice's casualty rows
    (for sessions without AQE; with AQE, skewed partitions are split at run time)."""
    if salt_share is None:
        return union_slices([join_slice(c, k, key) for c, k in slices])
    return union_slices([join_slice_salted(c, k, key, hot_keys(c, key, salt_share), salt_buckets) for c, k in slices])


def integrate_job(slices: Sequence[tuple[DataFrame, DataFrame]], key: str, out_path: str) -> str:
    return write_parquet(integrate(slices, key), out_path)
