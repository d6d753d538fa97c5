"""Arithmetic and formatting expressions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(a, b, eps: float = 1e-5) -> Column:
    """a / (b + eps); NULL where the shifted denominator is exactly zero."""
    return F.try_divide(_c(a), _c(b) + F.lit(eps))


def diff_of(a, b) -> Column:
    """a - b."""
    return _c(a) - _c(b)


def product(a, b) -> Column:
    """a * b."""
    return _c(a) * _c(b)


def signed_fmt(x, digits: int = 4) -> Column:
    """Number as text with an explicit sign."""
    return F.format_string(f"%+.{digits}f", _c(x))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in floating-point columns, so that averages and rules see one kind of missing."""
    floats = (T.DoubleType, T.FloatType)
    chosen = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, floats) and (cols is None or f.name in cols)
    }
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in chosen else F.col(c)
            for c in df.columns
        ]
    )
