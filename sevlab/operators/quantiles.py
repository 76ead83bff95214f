"""Exact quantiles from value counts, for any column size and cardinality.

The answer for probability p over n values is the smallest value v with #(x <= v) >= p*n (the SQL
``PERCENTILE_DISC``; the minimum for p = 0). Nulls and NaN are no values, as for ``approxQuantile``.

One aggregation counts the rows of every (column, group, value), with a map-side combine, so a value
that holds a third of the rows is one row. The counts are sorted by range into a table of the shared
folder; running sums inside each range partition plus the sums of the partitions before give every
value its ranks, and the wanted ranks are picked by a filter. No column, group or value list is held
by one task or the driver, and the same code runs at every size. All columns share the passes.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import number
from ..session import scratch_path


def value_counts(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """(c, g, v, n): rows of each value of column number ``c`` in group ``g`` (null without ``by``)."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), number(c).alias("v")) for i, c in enumerate(cols)])
    group = F.col(by) if by else F.lit(None).cast("string")
    return (df.select(group.alias("g"), F.explode(cells).alias("x")).select("x.c", "g", "x.v").filter(F.col("v").isNotNull())
            .groupBy("c", "g", "v").agg(F.count(F.lit(1)).alias("n")))


def ranked(counts: DataFrame) -> DataFrame:
    """``counts`` with ``before`` and ``upto`` (rows below a value, and with it) and ``total``."""
    order = ["c", "g", "v"]
    path = scratch_path(counts.sparkSession, "value-counts")
    counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    table = counts.sparkSession.read.parquet(path)
    sums = table.groupBy("c", "g", "part").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("c", "g")
    earlier = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(F.col("c").alias("c2"), F.col("g").alias("g2"), F.col("part").alias("part2"),
                          F.coalesce(earlier, F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("c", "g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    inside = table.withColumn("inside", upto)
    same = (F.col("c") == F.col("c2")) & F.col("g").eqNullSafe(F.col("g2")) & (F.col("part") == F.col("part2"))
    rows = inside.join(offsets, same).withColumn("upto", F.col("offset") + F.col("inside"))
    return rows.select("c", "g", "v", "n", (F.col("upto") - F.col("n")).alias("before"), "upto", "total")


def _holding(rank: Column) -> Column:
    """The value that holds a rank (counted from 1), as an aggregate over ranked values."""
    return F.max(F.when((F.col("before") < rank) & (F.col("upto") >= rank), F.col("v")))


def discrete(ranks: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(c, g, q): the smallest value with at least p * total rows up to it, for each probability."""
    wanted = [_holding(F.greatest(F.lit(float(p)) * F.col("total"), F.lit(1.0))) for p in probs]
    return ranks.groupBy("c", "g").agg(F.array(*wanted).alias("q"))


def interpolated(ranks: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(c, g, n, q): x[h] with h = (n - 1) p, linear between neighbouring order statistics."""
    place = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    pairs = [F.struct(_holding(F.floor(h) + 1).alias("low"), _holding(F.ceil(h) + 1).alias("high"), F.max(h - F.floor(h)).alias("part")) for h in place]
    found = ranks.groupBy("c", "g").agg(F.max("total").alias("n"), *[p.alias(f"p{i}") for i, p in enumerate(pairs)])
    values = [F.col(f"p{i}.low") + F.col(f"p{i}.part") * (F.col(f"p{i}.high") - F.col(f"p{i}.low")) for i in range(len(probs))]
    return found.select("c", "g", "n", F.array(*values).alias("q"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float] | None]:
    """{column: [value per probability], or None if the column has no value}. One row a column
    comes to the driver."""
    if not cols:
        return {}
    found = {r.c: list(r.q) for r in discrete(ranked(value_counts(df, cols)), probs).collect()}
    return {c: found.get(i) for i, c in enumerate(cols)}


def grouped_quantiles(df: DataFrame, group: str, col: str, probs: Sequence[float]) -> DataFrame:
    """(group, n, q): interpolated quantiles of ``col`` for each value of ``group``, a null one included;
    groups without a value are absent."""
    return interpolated(ranked(value_counts(df, [col], group)), probs).select(F.col("g").alias(group), "n", "q")
