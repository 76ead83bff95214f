"""Header CSV with its bad rows kept: every line becomes a good row or a reject with file and line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import read_csv

CORRUPT = "_corrupt_record"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of every line. A split numbers its own lines as it reads them; the splits before it in
    the file add their sizes (one small row a split), so no file passes through one task."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    raw = raw.withColumn("at", F.monotonically_increasing_id())
    splits = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), "first", F.coalesce(before, F.lit(0)).alias("before"))
    joined = raw.join(splits, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")))
    return joined.select("file", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line"), "value")


def read_csv_keeping_bad_rows(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of the header-CSV files at ``path``.

    Good rows have all columns, as text, or of the ``types`` given. A line is rejected, with its file, its line
    number, its text and the reason, if it has too few or too many cells (``cells``), if it is the first of a
    file whose header is not that of the others (``header``), or if a cell is no value of its column's type
    (``type <column>``). Blank lines are neither, as for Spark's reader. Good + rejected + headers = lines.
    A quoted cell holds no line break."""
    columns = read_csv(spark, path).columns
    types = dict(types or {})
    lines = numbered_lines(spark, path).filter(F.trim("value") != "")
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    parsed = lines.withColumn("cells", F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    is_header = F.lit(True)
    for c in columns:
        is_header = is_header & F.col(f"cells.`{c}`").eqNullSafe(F.lit(c))
    failed = [F.when(F.col(f"cells.`{c}`").isNotNull() & (F.col(f"cells.`{c}`") != "") & F.col(f"cells.`{c}`").try_cast(t).isNull(), F.lit(f"type {c}")) for c, t in types.items()]
    reason = F.coalesce(F.when(F.col(f"cells.{CORRUPT}").isNotNull(), "cells"), F.when((F.col("line") == 1) & ~is_header, "header"), *failed)
    judged = parsed.filter(~((F.col("line") == 1) & is_header)).withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[F.col(f"cells.`{c}`").try_cast(types.get(c, "string")).alias(c) for c in columns])
    return good, judged.filter(F.col("reason").isNotNull()).select("file", "line", "value", "reason")
