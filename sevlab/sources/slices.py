"""Tables kept slice by slice: a staged sink that replaces whole slices, and quantile states by slice."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size parameter of the quantile states.
SKETCH_SIZE = 1000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def reads_from(df: DataFrame, path: str) -> bool:
    """Whether the plan of ``df`` scans files below ``path``."""
    jvm, fs = _fs(df.sparkSession, path)
    whole = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath().rstrip("/")
    inside = [jvm.org.apache.hadoop.fs.Path(f).toUri().getPath() for f in df.inputFiles()]
    return any(f == whole or f.startswith(whole + "/") for f in inside)


def write_slices(df: DataFrame, path: str, slice_col: str) -> list[str]:
    """Replace in the table at ``path`` the slices (values of ``slice_col``) that ``df`` holds; others stay.

    The rows are first written whole to a hidden folder of the table. Only when that job has succeeded do the new
    slices take the places of the old ones, one rename each, so a failed run leaves the old rows and a rerun of
    a period replaces that period. A frame that reads the table itself is refused: its source would change
    under it. Returns the folders of the slices written."""
    if reads_from(df, path):
        raise ValueError(f"the frame reads {path}: write to another path, or cut its lineage first")
    spark = df.sparkSession
    jvm, fs = _fs(spark, path)
    to_path = jvm.org.apache.hadoop.fs.Path
    base, tag = path.rstrip("/"), uuid.uuid4().hex[:12]
    staged, retired = f"{base}/_staged-{tag}", f"{base}/_retired-{tag}"
    done = []
    try:
        df.write.partitionBy(slice_col).parquet(staged)
        for status in fs.listStatus(to_path(staged)):
            name = status.getPath().getName()
            if not status.isDirectory() or name.startswith(("_", ".")):
                continue
            place = to_path(f"{base}/{name}")
            if fs.exists(place):
                fs.mkdirs(to_path(retired))
                _renamed(fs, place, to_path(f"{retired}/{name}"))
            _renamed(fs, to_path(f"{staged}/{name}"), place)
            done.append(name)
    finally:
        fs.delete(to_path(staged), True)
    fs.delete(to_path(retired), True)
    return sorted(done)


def _renamed(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"could not rename {old} to {new}")


def read_slices(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table with its slice column (partition discovery skips hidden folders)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def rank_error(size: int = SKETCH_SIZE) -> float:
    """The normalised rank error of one quantile that a state of this size keeps in 99 of 100 cases, whatever
    the number of states merged (published for KLL sketches)."""
    return 2.296 / size**0.9723


def quantile_states(df: DataFrame, cols: Sequence[str], slice_col: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(slice, column_name, n, state): a KLL sketch of every slice's values of every column, in one pass with a
    map-side combine. Nulls and NaN are no values."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.col(slice_col), F.explode(cells).alias("x")).select(slice_col, "x.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return long.groupBy(slice_col, "column_name").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(size)).alias("state"))


def write_quantile_states(df: DataFrame, cols: Sequence[str], slice_col: str, path: str, size: int = SKETCH_SIZE) -> list[str]:
    """Keep the states of the slices in ``df`` at ``path``; the states of other slices stay as they are."""
    return write_slices(quantile_states(df, cols, slice_col, size).coalesce(1), path, slice_col)


def merged_quantiles(states: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column_name, n, prob, value) from stored states alone: no input row is read."""
    merged = states.groupBy("column_name").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("state").alias("state"))
    each = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("state", F.lit(float(p))).alias("value")) for p in probs])
    return merged.select("column_name", "n", F.explode(each).alias("q")).select("column_name", "n", "q.*")
