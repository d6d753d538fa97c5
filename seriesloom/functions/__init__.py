"""Column expressions: time, row-wise aggregates, ratios and formatting."""

from .rows import group_cols, row_max, row_mean, row_min, row_spread
from .scalars import (
    diff_of,
    nan_to_null,
    product,
    safe_ratio,
    signed_fmt,
)
from .times import (
    cyclic,
    epoch_s,
    epoch_us,
    hours_between,
    minutes_between,
    parse_ts,
    time_parts,
    trunc,
)

__all__ = [
    "cyclic",
    "diff_of",
    "epoch_s",
    "epoch_us",
    "group_cols",
    "hours_between",
    "minutes_between",
    "nan_to_null",
    "parse_ts",
    "product",
    "row_max",
    "row_mean",
    "row_min",
    "row_spread",
    "safe_ratio",
    "signed_fmt",
    "time_parts",
    "trunc",
]
