"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared
folder and read again as the next one's ``docs``. A stage works on all rows that the one before kept; all
but the last return the columns of ``documents``, the last one adds the shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sevlab.llm import jaccard_join, jump_shards, latent_leaks, mcd_rules, temperature_mix
from sevlab.llm.common import documents, release, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie outside their cell's ellipsoid go."""
    return mcd_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, similarity 0.8) stays."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return latent_leaks.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of smaller sources again as often as the target weights ask."""
    return temperature_mix.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every row by its doc_id."""
    return jump_shards.add_shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]
#: The covariance estimates and the latent space cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. A stage's table is deleted once the next one's is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            release(before)
        before = docs
    return docs
