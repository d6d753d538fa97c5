"""Audit of table layers: sizes, time span, value distribution and row spacing in one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_s
from ..operators.gaps import interval_stats
from ..operators.stats import summarize


@dataclass(frozen=True)
class Layer:
    df: DataFrame
    ts: str
    value: str
    keys: Sequence[str] = ()
    tie: Sequence[str] = ()


def audit(layers: Mapping[str, Layer]) -> DataFrame:
    """(layer, metric, value) for every layer; times in seconds since the epoch."""
    parts = []
    for name, layer in layers.items():
        df = layer.df
        totals = df.agg(
            F.count(F.lit(1)).cast("double").alias("rows"),
            F.lit(float(len(df.columns))).alias("columns"),
            F.min(epoch_s(layer.ts)).cast("double").alias("first_s"),
            F.max(epoch_s(layer.ts)).cast("double").alias("last_s"),
        )
        cells = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in totals.columns]
        values = summarize(df, [layer.value]).select(_metric("value"), "value")
        gaps = interval_stats(df, layer.ts, layer.keys, layer.tie).select(
            _metric("hours"), F.col("hours").alias("value")
        )
        parts += [
            p.select(F.lit(name).alias("layer"), "metric", "value")
            for p in (totals.select(F.inline(F.array(*cells))), values, gaps)
        ]
    return reduce(DataFrame.unionByName, parts)


def _metric(prefix: str):
    return F.format_string(f"{prefix}_p%.0f", F.col("prob") * 100).alias("metric")
