"""Stratified samples and splits of exact size, without a sort: the rows of the least keyed hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .forest import row_key

DIGIT_BITS, DIGITS = 15, 4  # the 60 bits of a row key, highest digit first


def fit_cuts(rows: DataFrame, fraction: float) -> DataFrame:
    """(g, cut, ties) of (g, h) rows: the ceil(fraction * n) rows of least ``h`` in a group are those with ``h`` below
    ``cut`` and ``ties`` of those at it. Each digit of the hash is one histogram (at most 2^DIGIT_BITS counts a
    group) of the rows that still agree with the group's cut, so groups of any size come down to one row each."""
    spark, total = rows.sparkSession, DIGIT_BITS * DIGITS
    state = rows.groupBy("g").agg(F.ceil(F.lit(float(fraction)) * F.count(F.lit(1)) - 1e-9).alias("need")).withColumn("prefix", F.lit(0).cast("bigint"))
    for digit in range(DIGITS):
        path = scratch_path(spark, "sample-cuts")
        state.write.parquet(path)  # a row a group; cuts the lineage of the passes
        state = spark.read.parquet(path)
        low = total - DIGIT_BITS * (digit + 1)
        known = state.select(F.col("g").alias("of"), "need", "prefix").filter("need > 0")
        agree = rows.join(known, F.col("g").eqNullSafe(F.col("of")) & (F.shiftright("h", low + DIGIT_BITS) == F.col("prefix")))
        counts = agree.groupBy("g", "need", F.shiftright("h", low).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("g").orderBy("value"))
        state = counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))).select(
            "g", (F.col("need") - F.col("upto") + F.col("n")).alias("need"), F.col("value").alias("prefix"))
    return state.select("g", F.col("prefix").alias("cut"), F.col("need").alias("ties"))


def exact_split(df: DataFrame, label: str, fraction: float, keys: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """(sample, rest) with exactly ceil(fraction * n) rows of each class (a null class too), chosen by a hash of the
    ``keys``: the same rows on any layout or rerun. Rows with one hash at the cut are alike in their keys; as many
    of them are taken as the size needs, in order of a hash of all their columns."""
    taken, mark = "_in_sample", "_cut"
    hashed = df.withColumn("_h", row_key(*keys))
    cuts = fit_cuts(hashed.select(F.col(label).alias("g"), F.col("_h").alias("h")), fraction).select(F.col("g").alias("_g"), F.col("cut").alias(mark), "ties")
    path = scratch_path(df.sparkSession, "sample-cuts")
    cuts.write.parquet(path)
    cuts = df.sparkSession.read.parquet(path)
    joined = hashed.join(cuts, F.col(label).eqNullSafe(F.col("_g")), "left")  # a row a class
    at_cut = F.col("_h") == F.col(mark)
    # rows below and above the cut are decided alone; those at it (rows alike in their keys) are ranked
    order = Window.partitionBy(label, "_h").orderBy(F.xxhash64(*[F.col(c) for c in df.columns]))
    ties = joined.filter(at_cut).withColumn(taken, F.row_number().over(order) <= F.col("ties"))
    others = joined.filter(~F.coalesce(at_cut, F.lit(False))).withColumn(taken, F.coalesce(F.col("_h") < F.col(mark), F.lit(False)))
    decided = others.unionByName(ties)
    return decided.filter(taken).select(*df.columns), decided.filter(~F.col(taken)).select(*df.columns)
