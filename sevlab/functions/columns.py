"""Column expressions. Everything here is a built-in Spark expression (JVM-side, codegen'd)."""

from __future__ import annotations

from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if(c: str | Column, codes: Iterable[Any]) -> Column:
    """Value, or null where it equals one of the sentinel codes (null stays null)."""
    codes = list(codes)
    x = _col(c)
    cond = x == F.lit(codes[0]) if len(codes) == 1 else x.isin(codes)
    return F.when(cond, F.lit(None)).otherwise(x)


def to_int(c: str | Column, on_error: str = "fail") -> Column:
    """String -> int. ``on_error='fail'`` keeps Spark's ANSI behaviour (bad text fails the job);
    ``'null'`` turns bad text into null."""
    x = _col(c)
    return x.try_cast("int") if on_error == "null" else x.cast("int")


def cast_to(c: str | Column, dtype: str, on_error: str = "fail") -> Column:
    x = _col(c)
    return x.try_cast(dtype) if on_error == "null" else x.cast(dtype)


def parse_date(c: str | Column, fmt: str, on_error: str = "fail") -> Column:
    """Text in ``fmt`` (e.g. ``dd/MM/yyyy``) -> date."""
    x = _col(c)
    return F.try_to_date(x, fmt) if on_error == "null" else F.to_date(x, fmt)


def hour_of(c: str | Column, sep: str = ":", on_error: str = "fail") -> Column:
    """Leading field of a ``HH:mm`` text as int (the hour)."""
    head = F.split(_col(c), sep).getItem(0)
    return head.try_cast("int") if on_error == "null" else head.cast("int")


def bin_by_ranges(c: str | Column, ranges: Sequence[tuple[Any, Any, Any]], other: Any) -> Column:
    """First ``label`` whose half-open range ``[lo, hi)`` holds the value, else ``other``
    (null input also gets ``other``)."""
    x = _col(c)
    expr = None
    for lo, hi, label in ranges:
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def remap(c: str | Column, mapping: Mapping[Any, Any]) -> Column:
    """Replace listed values (e.g. swap 1 and 3), leave all others unchanged."""
    x = _col(c)
    expr = None
    for k, v in mapping.items():
        cond = x == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return x if expr is None else expr.otherwise(x)


FRACTIONAL = ("double", "float")


def without_nan(c: str, dtype: str) -> Column:
    """The column with NaN turned into null, so that one null test finds every missing value."""
    return F.when(~F.isnan(c), F.col(c)) if dtype in FRACTIONAL else F.col(c)


def is_missing(c: str, dtype: str) -> Column:
    """No value: null, or NaN in a column of fractions."""
    return without_nan(c, dtype).isNull()


def number(c: str) -> Column:
    """The column as double, NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def between(c: str | Column, lo: Any, hi: Any) -> Column:
    """``lo <= c <= hi``; null is rejected (a filter drops it)."""
    x = _col(c)
    return (x >= F.lit(lo)) & (x <= F.lit(hi))


def null_or_between(c: str | Column, lo: Any, hi: Any) -> Column:
    """Null is accepted, otherwise ``lo <= c <= hi``."""
    x = _col(c)
    return x.isNull() | ((x >= F.lit(lo)) & (x <= F.lit(hi)))


def outside_flag(c: str | Column, lo: Any, hi: Any) -> Column:
    """1 when the value lies outside ``[lo, hi]``, 0 when inside or null: the range test, negated, with
    an unknown answer counted as inside."""
    return F.coalesce(~between(c, lo, hi), F.lit(False)).cast("int")


def any_flag(flags: Sequence[str | Column]) -> Column:
    """The greatest of 0/1 flags."""
    cols = [_col(f) for f in flags]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def unit_hash(cols: Sequence[str | Column], buckets: int = 1000) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from the md5 of the columns' text.

    Same value on every run, partitioning and engine (DuckDB computes the same number),
    so a split or sample made from it is reproducible. Use integer or string columns.
    """
    text = F.concat_ws("|", *[_col(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
