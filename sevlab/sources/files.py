"""CSV and parquet readers/writers, schema report, rows-to-table."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """CSV with a header row; every column a string (no schema inference, so no extra pass). ``columns``: all
    columns in order, those that the folder is partitioned by last; a folder without a file is then an empty table."""
    reader = spark.read.option("header", "true").option("inferSchema", "false")
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """Parquet scan; ``recursive`` reads every file below ``path`` (no partition discovery)."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    """Parquet sink, overwrite by default. Returns the path, so a job can re-read what it wrote
    (a lineage cut that survives executor loss)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode(mode).option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable (the ``printSchema`` content as a table).

    Built from the schema on the driver (its size is the number of columns, not rows)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows under a total order (``show(n)`` made deterministic); a top-k, not a scan cap."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)


def rows_to_frame(spark: SparkSession, rows: Sequence[tuple[Any, ...]], columns: Sequence[str] | str) -> DataFrame:
    """Small in-memory rows (e.g. one feature vector to score) as a DataFrame."""
    return spark.createDataFrame(list(rows), columns if isinstance(columns, str) else list(columns))
