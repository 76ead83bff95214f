"""Sharding by jump consistent hashing: a key and the number of shards decide, without a ring table.

``jump`` follows the published algorithm (Lamping and Veach, 2014) on whole numpy columns: the
key seeds a 64-bit linear congruential generator whose draws give the next shard count at which the
key moves. With one more shard a key either stays or moves into the new shard.

Slots number each shard's rows from 0 without gaps, in the order of (key, checksum, size). No shard
is gathered or sorted by one task: the rows are sorted by range into files of the shared folder,
each file is cut into blocks of ``BLOCK`` rows, rows are numbered inside a block, and the blocks'
counts are added up per shard.

Defined results: integer keys are used as they are, other types by xxhash64; a null key counts as 0
and a null text as empty (size 1, checksum 0); equal keys share a shard, equal rows get neighbouring
slots; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlab.llm.common import free_name, written

#: The multiplier of the published algorithm.
MULTIPLIER = 2862933555777941757
BLOCK = 65_536
SHARDS = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, 0 to shards - 1."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    at, draw = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state)) if shards > 0 else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        while len(moving):
            at[moving] = draw[moving]
            state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
            factor = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1)
            draw[moving] = np.minimum((at[moving] + 1) * factor, float(shards)).astype(np.int64)
            moving = moving[draw[moving] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key column."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return shard(key)


def key_column(df: DataFrame, key: str) -> Column:
    """``key`` as a 64-bit integer without nulls."""
    whole = isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    value = df[key].cast("long") if whole else F.xxhash64(df[key])
    return F.when(df[key].isNull(), F.lit(0).cast("long")).otherwise(value)


def add_shard(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """``df`` and its shard (a clashing column is kept; the new one gets an underscore): a narrow stage,
    e.g. for ``write.partitionBy``."""
    return df.withColumn(free_name(df, name), shard_of(key_column(df, key), shards))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard with one shard more, for every row."""
    text = F.coalesce(docs["text"], F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       key_column(docs, "doc_id").alias("key"))
    order = ["doc_id", "text_crc32", "size"]
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.select("doc_id", "size", "text_crc32", shard_of(F.col("key"), shards).alias("shard"), shard_of(F.col("key"), shards + 1).alias("grown_shard")), "shards")
    block = ["part", "file", "block", "shard"]
    rows = placed.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).select(
        "*", F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("part"), F.floor(F.col("row") / BLOCK).alias("block"))
    before = Window.partitionBy("shard").orderBy("part", "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n")).select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("row")) - 1
    return rows.join(counts, block).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + inside).alias("slot"), "grown_shard")
