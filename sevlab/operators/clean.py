"""Cleaning: column keep-lists, typed projections, sentinels, null drops, dedup, imputation."""

from __future__ import annotations

import math
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cast_to, null_if, number, without_nan


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Drop every column not named in ``keep``; the input's column order is kept.
    (Pruned at the scan: only kept columns are read.)"""
    wanted = set(keep)
    return df.select(*[F.col(c) for c in df.columns if c in wanted])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def typed_projection(df: DataFrame, spec: Mapping[str, str | Column], on_error: str = "fail") -> DataFrame:
    """One ``select``: a type name casts the column of that name, a Column is taken as is
    (e.g. a parsed date or an hour), ``None`` keeps the column. Output order = ``spec`` order."""
    out = []
    for name, how in spec.items():
        if how is None:
            out.append(F.col(name))
        elif isinstance(how, Column):
            out.append(how.alias(name))
        else:
            out.append(cast_to(name, how, on_error).alias(name))
    return df.select(*out)


def reject_counts(raw: DataFrame, spec: Mapping[str, str | Column | None]) -> DataFrame:
    """One row: for each typed column that has a raw column of the same name, the number of
    rows whose raw text is present but does not parse (``<col>_rejected``). ``spec`` is the
    null-on-error typing (e.g. ``typed_projection`` spec built with ``on_error='null'``)."""
    aggs = []
    for name, how in spec.items():
        if how is None or name not in raw.columns:
            continue
        typed = how if isinstance(how, Column) else cast_to(name, how, "null")
        aggs.append(F.count(F.when(F.col(name).isNotNull() & typed.isNull(), F.lit(1))).alias(f"{name}_rejected"))
    return raw.agg(*aggs) if aggs else raw.limit(1).select(F.lit(0).alias("rejected"))


def cast_by_rule(
    df: DataFrame,
    strings: Sequence[str],
    doubles: Sequence[str],
    default: str = "int",
    on_error: str = "fail",
) -> DataFrame:
    """Named columns stay strings, named columns become doubles, every other column ``default``.
    Output order: strings, then the default-typed columns, then doubles."""
    s = [c for c in strings if c in df.columns]
    d = [c for c in doubles if c in df.columns]
    rest = [c for c in df.columns if c not in set(strings) | set(doubles)]
    return df.select(
        *[F.col(c) for c in s],
        *[cast_to(c, default, on_error).alias(c) for c in rest],
        *[cast_to(c, "double", on_error).alias(c) for c in d],
    )


def sentinels_to_null(df: DataFrame, sentinels: Mapping[str, Sequence[Any]]) -> DataFrame:
    """Turn sentinel codes into nulls, all columns in one projection (column order kept)."""
    return df.select(*[null_if(c, sentinels[c]).alias(c) if c in sentinels else F.col(c) for c in df.columns])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (in any column when ``subset`` is None)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, merged: str | None = None) -> DataFrame:
    """One row per value of ``keys`` (null keys compare equal).

    ``order_by=None`` is Spark's ``dropDuplicates``: which row survives is unspecified.
    With ``order_by`` the survivor is the row with the smallest (order_by, other columns)
    tuple, nulls first — reproducible on any layout. Both are aggregations with a map-side
    partial step, so a key holding a third of all rows collapses before the shuffle.
    ``merged`` names a column for the number of rows that each survivor stands for.
    """
    keys = list(keys)
    if order_by is None and not merged:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by or () if c in rest] + [c for c in rest if c not in (order_by or ())]
    if not order and not merged:
        return df.select(*keys).distinct()
    survivor = [] if not order else [(F.first if order_by is None else F.min)(F.struct(*order)).alias("_survivor")]
    count = [F.count(F.lit(1)).alias(merged)] if merged else []
    kept = df.groupBy(*keys).agg(*survivor, *count)
    return kept.select(*[F.col(c) for c in keys], *[F.col("_survivor")[c].alias(c) for c in order], *([merged] if merged else [])).select(*df.columns, *([merged] if merged else []))


def fill_values(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """``fillna`` per column. A value is cast to the column's type (a median of 30.7 fills an
    int column with 30), as Spark's ``fillna`` does. ``None`` values are skipped
    (an all-null column has no median or mode to fill with)."""
    vals = {c: v for c, v in values.items() if v is not None and not (isinstance(v, float) and math.isnan(v))}
    if not vals:
        return df
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in vals:
            out.append(F.coalesce(F.col(c), F.lit(vals[c]).cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], rel_error: float) -> dict[str, list | None]:
    """Quantiles of several columns, all columns sharing each pass.

    ``rel_error > 0``: Spark's GK sketch in ONE aggregation (accuracy = 1/error), with the rank
    error of ``DataFrame.approxQuantile``.
    ``rel_error == 0``: exact (``PERCENTILE_DISC``: smallest v with #(x <= v) >= p*n), from value
    counts (see ``operators.quantiles``).
    Values are doubles (columns are cast first, as ``approxQuantile`` does); nulls and NaN are
    left out; a column with no value gives ``None``.
    """
    if not cols:
        return {}
    if rel_error == 0:
        from .quantiles import exact_quantiles
        return exact_quantiles(df, cols, probs)
    aggs = [quantile_expr(c, probs, rel_error).alias(f"q{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    out: dict[str, list | None] = {}
    for i, c in enumerate(cols):
        v = row[f"q{i}"]
        out[c] = None if v is None or any(x is None for x in v) else [float(x) for x in v]
    return out


def quantile_expr(c: str, probs: Sequence[float], rel_error: float) -> Column:
    """Aggregate expression (approximate): ``array<double>`` of the quantiles of ``c``."""
    if rel_error <= 0:
        raise ValueError("exact quantiles are computed by fit_quantiles (several passes), not one expression")
    accuracy = int(math.ceil(1.0 / rel_error))
    return F.percentile_approx(number(c), list(probs), accuracy)


def fit_medians(df: DataFrame, cols: Sequence[str], rel_error: float) -> dict[str, float | None]:
    q = fit_quantiles(df, cols, [0.5], rel_error)
    return {c: (v[0] if v else None) for c, v in q.items()}


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, Any]:
    """Most frequent value of each column; on a tie the smallest (deterministic, unlike a plain
    ``mode``). Nulls and NaN are not counted. One value count of all columns with a map-side combine;
    the winner of each column is an aggregate too, so no task holds a column's values."""
    if not cols:
        return {}
    types = dict(df.dtypes)
    numeric = lambda c: types[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or types[c].startswith("decimal")
    cells = F.array(*[F.struct(F.lit(i).alias("c"), (number(c) if numeric(c) else F.lit(None).cast("double")).alias("x"),
                               without_nan(c, types[c]).cast("string").alias("s")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(cells).alias("e")).select("e.*").filter(F.col("s").isNotNull()).groupBy("c", "x", "s").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("k"), "x", "s")).alias("b")).select("c", "b.s")
    found = {r.c: r.s for r in best.collect()}
    typed = df.sparkSession.range(1).select(*[F.lit(found.get(i)).cast(types[c]).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: typed[i] for i, c in enumerate(cols)}


def impute_median(df: DataFrame, cols: Sequence[str], rel_error: float) -> tuple[DataFrame, dict[str, float | None]]:
    medians = fit_medians(df, cols, rel_error)
    return fill_values(df, medians), medians


def impute_mode(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, Any]]:
    modes = fit_modes(df, cols)
    return fill_values(df, modes), modes


def fit_medians_and_modes(
    df: DataFrame, median_cols: Sequence[str], mode_cols: Sequence[str], rel_error: float
) -> tuple[dict[str, float | None], dict[str, Any]]:
    """Medians and modes of the same table (the columns are imputed independently)."""
    return fit_medians(df, median_cols, rel_error), fit_modes(df, mode_cols)
