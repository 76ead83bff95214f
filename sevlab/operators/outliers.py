"""Outliers: IQR fences (fitted), then drop, or flag and keep with a plausibility filter."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions import any_flag, between, null_or_between, outside_flag
from .stats import iqr_table


def fit_iqr_bounds(df: DataFrame, cols: Sequence[str], rel_error: float, factor: float = 1.5) -> dict[str, dict]:
    """The rows of ``iqr_table`` by column name. A column with no value gets no bounds."""
    rows = iqr_table(df, cols, rel_error, factor).filter("iqr IS NOT NULL").collect() if cols else []
    return {r.column_name: {k: v for k, v in r.asDict().items() if k != "column_name"} for r in rows}


def drop_outside(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows with ``lo <= c <= hi`` for every bounded column; null is dropped."""
    cond = None
    for c, (lo, hi) in bounds.items():
        e = between(c, lo, hi)
        cond = e if cond is None else cond & e
    return df if cond is None else df.filter(cond)


def domain_filter(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows whose value is null or inside ``[lo, hi]`` (drops only implausible values)."""
    cond = None
    for c, (lo, hi) in bounds.items():
        e = null_or_between(c, lo, hi)
        cond = e if cond is None else cond & e
    return df if cond is None else df.filter(cond)


def flag_outliers(df: DataFrame, bounds: Mapping[str, tuple[float, float]], any_col: str = "has_any_outlier") -> DataFrame:
    """Add ``<c>_is_outlier`` (1 outside the fences, 0 inside or null) per column and
    ``has_any_outlier`` (1 if any flag is set). One projection."""
    flags = {f"{c}_is_outlier": outside_flag(c, lo, hi) for c, (lo, hi) in bounds.items()}
    if not flags:
        return df
    out = df.withColumns(flags)
    return out.withColumn(any_col, any_flag(list(flags)))


def fences(bounds: Mapping[str, dict]) -> dict[str, tuple[float, float]]:
    return {c: (b["lower_bound"], b["upper_bound"]) for c, b in bounds.items()}
