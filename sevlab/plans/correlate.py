"""Correlate job: drop incomplete rows, swap severity codes so higher = worse, Pearson matrix."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions import remap
from ..operators.stats import correlation_long


def correlation_input(df: DataFrame, cols: Sequence[str], swap: Mapping, swapped: Sequence[str]) -> DataFrame:
    d = df.select(*cols).dropna()
    return d.withColumns({c: remap(c, swap) for c in swapped if c in cols})


def correlate(df: DataFrame, cols: Sequence[str], swap: Mapping, swapped: Sequence[str]) -> DataFrame:
    return correlation_long(correlation_input(df, cols, swap, swapped), cols)
