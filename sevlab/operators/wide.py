"""Pearson correlation of hundreds of columns: blocked cross products added in a tree."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

FAN_IN = 32
BLOCK = 256
_SUMS = "part long, band int, n long, sums binary, cross binary"


def _cross_products(batches: Iterable[pa.RecordBatch], centre: np.ndarray, products: bool = True) -> Iterator[pa.RecordBatch]:
    """A task's complete rows as their number, sums and cross products about ``centre``, a row a band of columns."""
    k = len(centre)
    n, sums, cross = 0, np.zeros(k), np.zeros((k if products else 0, k))
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64) if len(batch) else np.zeros((0, k))
        x = x[~np.isnan(x).any(axis=1)] - centre
        n, sums = n + len(x), sums + x.sum(axis=0)
        if products:
            cross += x.T @ x
    part = TaskContext.get().partitionId()
    bands = list(range(0, k if products else 1, BLOCK)) if n else []
    yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(bands), pa.int64()), "band": pa.array([b // BLOCK for b in bands], pa.int32()), "n": pa.array([n] * len(bands), pa.int64()),
                                      "sums": pa.array([sums.tobytes() for _ in bands], pa.binary()), "cross": pa.array([cross[b:b + BLOCK].tobytes() for b in bands], pa.binary())})


def _summed(rows: DataFrame, centre: np.ndarray, products: bool) -> list:
    """The added partial results, a row a band."""
    parts = rows.mapInArrow(lambda batches: _cross_products(batches, centre, products), _SUMS)
    return parts.groupBy("band", F.floor(F.col("part") / FAN_IN)).applyInArrow(_added, _SUMS).groupBy("band").applyInArrow(_added, _SUMS).collect()


def _added(table: pa.Table) -> pa.Table:
    """The sums of one band's partial results, in the order of their parts."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    total = [sum(np.frombuffer(r[c]) for r in rows).tobytes() for c in ("sums", "cross")]
    return pa.table({"part": pa.array([rows[0]["part"]], pa.int64()), "band": pa.array([rows[0]["band"]], pa.int32()), "n": pa.array([sum(r["n"] for r in rows)], pa.int64()),
                     "sums": pa.array([total[0]], pa.binary()), "cross": pa.array([total[1]], pa.binary())})


def correlation_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """As ``stats.correlation_long`` (i, j, col_i, col_j, r), for any number of columns whose k x k matrix of
    doubles fits a task (500 columns: 2 MB): two passes, one for the means and one in which each task adds matrix
    products of its Arrow batches (rows with a null or NaN in any column are left out); the partial results are added ``FAN_IN`` at a time, a band of columns a row."""
    spark, cols = df.sparkSession, list(cols)
    ship_package(spark)
    schema = "i int, j int, col_i string, col_j string, r double"
    k = len(cols)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    first = _summed(rows, np.zeros(k), False)
    centre = np.frombuffer(first[0].sums) / first[0].n if first else np.zeros(k)
    n, sums, cross = 0, np.zeros(k), np.zeros((k, k))
    for r in _summed(rows, centre, True):  # one matrix in bands
        n, sums = r.n, np.frombuffer(r.sums)
        cross[r.band * BLOCK:(r.band + 1) * BLOCK] = np.frombuffer(r.cross).reshape(-1, k)
    moments = cross - np.outer(sums, sums) / n if n else cross
    noise = n * (1e-14 * np.abs(centre)) ** 2  # what rounding leaves of a constant column
    spread = np.sqrt(np.where(np.diag(moments) > noise, np.diag(moments), 0.0))
    scale = np.outer(spread, spread)
    r = np.divide(moments, scale, out=np.full((k, k), np.nan), where=scale > 0)
    np.fill_diagonal(r, 1.0)
    i, j = (x.ravel() for x in np.indices((k, k)))
    names = np.array(cols, object)
    return spark.createDataFrame(pa.table({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "col_i": pa.array(names[i]), "col_j": pa.array(names[j]), "r": pa.array(r.ravel())}), schema)
