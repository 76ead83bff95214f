"""Frequency-ordered category indexes that stay distributed.

As ``StringIndexer`` with ``frequencyDesc`` and ``keep``: the most frequent value of a column has index 0, ties
go to the smaller text, nulls and values unseen in the fit get the number of values. Unlike there, the values
never meet on the driver or in one task:

* one aggregation counts the (column, value) pairs of all columns, with a map-side combine;
* the counts are sorted by range of (column, count descending, value) into a table of the shared folder; a
  value's index is its place in its range partition plus the sizes of the column's earlier partitions (a few
  numbers a partition);
* columns with at most ``LITERAL_VALUES`` values are looked up in a literal map inside the projection; others
  meet the table in an equi join, whose strategy Spark picks from the sizes it measures.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

LITERAL_VALUES = 100


@dataclass
class CategoryIndex:
    """A fitted index: a table (c, value, n, idx) at ``path`` and the number of values of each column."""
    path: str
    columns: list[str]
    sizes: list[int]
    maps: dict[int, dict[str, float]] | None = None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def mapping(self, spark: SparkSession) -> DataFrame:
        """(column_name, value, n, idx): every value's index."""
        names = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("c") + 1)
        return self.table(spark).select(names.alias("column_name"), "value", "n", "idx")

    def transform(self, df: DataFrame, suffix: str = "_idx") -> DataFrame:
        """``df`` with ``<column><suffix>`` (double) for every fitted column."""
        table = self.table(df.sparkSession)
        if self.maps is None:  # at most LITERAL_VALUES values a column
            maps = {i: {} for i, n in enumerate(self.sizes) if n <= LITERAL_VALUES}
            for r in table.filter(F.col("c").isin(list(maps))).select("c", "value", "idx").collect() if maps else []:
                maps[r.c][r.value] = r.idx
            self.maps = maps
        maps = self.maps
        out = df
        for i, column in enumerate(self.columns):
            if i not in maps:
                one = table.filter(F.col("c") == i).select(F.col("value").alias("_category"), F.col("idx").alias("_category_idx"))
                key = _text(F.col(column))
                # a null finds nothing: it is spread over the tasks by the row instead of meeting in one
                out = out.join(one, key == F.col("_category"), "left").withColumn(f"{column}{suffix}", F.coalesce("_category_idx", F.lit(float(self.sizes[i])))).drop("_category", "_category_idx")
        looked_up = {f"{self.columns[i]}{suffix}": _looked_up(_text(F.col(self.columns[i])), m, self.sizes[i]) for i, m in maps.items()}
        out = out.withColumns(looked_up) if looked_up else out
        return out.select(*df.columns, *[f"{c}{suffix}" for c in self.columns])


def _text(value: Column) -> Column:
    return value.cast("string")


def _looked_up(key: Column, values: dict[str, float], missing: int) -> Column:
    if not values:
        return F.lit(float(missing))
    literal = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, key), F.lit(float(missing)))


def fit_category_index(df: DataFrame, cols: Sequence[str], path: str | None = None) -> CategoryIndex:
    """Index the values of ``cols`` (as text); the table goes to ``path``, a scratch folder unless given.
    Only the number of values of each column and partition comes to the driver."""
    spark, cols = df.sparkSession, list(cols)
    cells = F.array(*[F.struct(F.lit(i).alias("c"), _text(F.col(c)).alias("value")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(cells).alias("x")).select("x.*").filter(F.col("value").isNotNull()).groupBy("c", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("c"), F.col("n").desc(), F.col("value")]
    sorted_path = scratch_path(spark, "category-counts")
    counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).write.parquet(sorted_path)
    table = spark.read.parquet(sorted_path)
    parts = table.groupBy("c", "part").agg(F.count(F.lit(1)).alias("m"))
    earlier = F.sum("m").over(Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(F.col("c").alias("c2"), F.col("part").alias("part2"), F.coalesce(earlier, F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("c", "part").orderBy(F.col("n").desc(), "value"))
    indexed = table.withColumn("place", place).join(offsets, (F.col("c") == F.col("c2")) & (F.col("part") == F.col("part2")))
    out = path or scratch_path(spark, "category-index")
    indexed.select("c", "value", "n", (F.col("offset") + F.col("place") - 1).cast("double").alias("idx")).write.mode("overwrite").parquet(out)
    sizes = {r.c: r.m for r in parts.groupBy("c").agg(F.sum("m").alias("m")).collect()}
    return CategoryIndex(out, cols, [int(sizes.get(i, 0)) for i in range(len(cols))])


def load_category_index(spark: SparkSession, path: str, cols: Sequence[str]) -> CategoryIndex:
    """A written index, for the columns that it was fitted on."""
    sizes = {r.c: r["count"] for r in spark.read.parquet(path).groupBy("c").count().collect()}
    return CategoryIndex(path, list(cols), [int(sizes.get(i, 0)) for i in range(len(cols))])
