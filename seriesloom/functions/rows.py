"""Aggregates across the columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_mean(cols: Sequence[str], skip_nulls: bool = False) -> Column:
    """Mean over ``cols``; NULL as soon as one is NULL unless ``skip_nulls``."""
    if not skip_nulls:
        return reduce(add, [F.col(c) for c in cols]) / F.lit(float(len(cols)))
    total = reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    present = reduce(add, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(total, present.cast("double"))


def row_max(cols: Sequence[str]) -> Column:
    """Largest non-null value of ``cols``."""
    return F.greatest(*[F.col(c) for c in cols])


def row_min(cols: Sequence[str]) -> Column:
    """Smallest non-null value of ``cols``."""
    return F.least(*[F.col(c) for c in cols])


def row_spread(cols: Sequence[str]) -> Column:
    """Largest minus smallest non-null value of ``cols``."""
    return row_max(cols) - row_min(cols)


def group_cols(df: DataFrame, prefix: str) -> list[str]:
    """Columns named ``prefix`` plus a number, in numeric order."""
    tails = [(c, c[len(prefix):]) for c in df.columns if c.startswith(prefix)]
    return [c for c, _ in sorted(((c, int(t)) for c, t in tails if t.isdigit()), key=lambda p: p[1])]
