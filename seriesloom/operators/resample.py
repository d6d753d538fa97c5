"""Resampling to a fixed grain and joins on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null, trunc


def resample(
    df: DataFrame,
    ts: str,
    grain: str,
    aggs: Mapping[str, str],
    keys: Sequence[str] = (),
    out: str | None = None,
    without_nan: bool = False,
) -> DataFrame:
    """One row per series and grain; ``aggs`` maps a column to avg, max, min, sum, count or stddev. NaN counts as
    missing; ``without_nan`` says that the input has none, which keeps the generated code small."""
    return (df if without_nan else nan_to_null(df, list(aggs))).groupBy(*keys, trunc(ts, grain).alias(out or ts)).agg(
        *[getattr(F, fn)(c).alias(c) for c, fn in aggs.items()]
    )


def join_on_grain(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    grain: str,
    keys: Sequence[str] = (),
    out: str = "ts",
) -> DataFrame:
    """Inner join of two series on their common grain; the strategy is left to the optimizer."""
    a = left.withColumn(out, trunc(left_ts, grain))
    b = right.withColumn(out, trunc(right_ts, grain))
    a = a if left_ts == out else a.drop(left_ts)
    b = b if right_ts == out else b.drop(right_ts)
    return a.join(b, [*keys, out], "inner")
