"""Column expressions shared by the operators."""

from .columns import (  # noqa: F401
    any_flag,
    between,
    bin_by_ranges,
    cast_to,
    hour_of,
    is_missing,
    null_if,
    null_or_between,
    number,
    outside_flag,
    parse_date,
    remap,
    to_int,
    unit_hash,
    without_nan,
)
