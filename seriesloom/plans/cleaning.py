"""Cleaning cascade: rule and quantile filters, group after group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.asof import asof_join
from ..operators.quality import all_of, funnel
from ..operators.quantiles import DIRECT_ROWS, inside_bounds, quantile_bounds
from .spec import CleaningStep


def match_targets(
    targets: DataFrame, sensors: DataFrame, ts: str = "dt", sensor_ts: str = "sensor_dt", keys: Sequence[str] = ()
) -> DataFrame:
    """Each target with the last sensor reading at or before it."""
    return asof_join(targets, sensors.withColumnRenamed(ts, sensor_ts), ts, sensor_ts, keys)


def cascade_conditions(
    df: DataFrame, steps: Sequence[CleaningStep], direct_rows: int = DIRECT_ROWS
) -> dict[str, Column]:
    """The condition of every step, with its quantile bounds as literals.

    Each step's quantiles are taken from the rows the steps before it left, so the frame is read several
    times: pass one that is stored, not one that is expensive to compute (see ``sources.staging``).
    """
    conditions: dict[str, Column] = {}
    for step in steps:
        rules = all_of(step.rules)
        condition = rules
        if step.trim:
            base = df.where(rules) if step.bounds_after_rules else df
            bounds = quantile_bounds(base, step.trim, step.lo, step.hi, direct_rows=direct_rows)
            condition = rules & inside_bounds(bounds)
        conditions[step.name] = condition
        df = df.where(condition)
    return conditions


def clean_cascade(
    df: DataFrame, steps: Sequence[CleaningStep], direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """The rows that survive every step."""
    for condition in cascade_conditions(df, steps, direct_rows).values():
        df = df.where(condition)
    return df


def cleaning_funnel(
    df: DataFrame, steps: Sequence[CleaningStep], direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Rows before, after and removed per step."""
    return funnel(df, cascade_conditions(df, steps, direct_rows))
