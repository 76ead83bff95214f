"""Helpers of this package: scratch tables in the shared folder and column naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sevlab.session import delete_path, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back: cuts the lineage, so that
    a lost executor costs a re-read and not a recomputation, and the work is done once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def release(table: DataFrame) -> None:
    """Delete a table that ``written`` has made, once nothing reads it any more (at the latest the program's
    end does)."""
    delete_path(table.sparkSession, table._scratch_path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def key_of(*columns: Column) -> Column:
    """One string for a tuple of columns; nulls are told from empty strings."""
    return F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)]))
