"""Gold layer: the feature table of a series, from a declarative spec."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cyclic, time_parts
from ..operators.blocks import HOUR, Frames, Stage, over_blocks
from ..operators.dedup import dedup
from ..operators.quality import require_any
from ..operators.windows import (
    acceleration_stage,
    diff_stage,
    drop_after_gap,
    elapsed_stage,
    lag_stage,
    lead_stage,
    roll_stage,
    target_stage,
    velocity_stage,
)
from .spec import FeatureSpec
from ..sources.staging import staged


def time_features(ts: str, pi: float | None = None) -> dict[str, Column]:
    """Calendar parts of the event time and their position on the day and week circle."""
    parts = time_parts(ts)
    hour_sin, hour_cos = cyclic(parts["hour"], 24, pi)
    dow_sin, dow_cos = cyclic(parts["day_of_week"], 7, pi)
    return {
        **parts,
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
    }


def together(*stages: Stage) -> Stage:
    """Several stages in one projection, so that Spark plans them as one window."""

    def build(f: Frames) -> dict[str, Column]:
        return {name: e for s in stages for name, e in s(f).items()}

    return build


def build_features(
    df: DataFrame,
    spec: FeatureSpec,
    ts: str = "si_dt",
    keys: Sequence[str] = (),
    deduplicate: bool = True,
    width_s: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Feature table: dedup, gap filter, row features, windows, future targets, completeness filter.

    ``ts`` has whole seconds. All windows share one block partitioning and one sort; only the columns
    they read travel with the extra rows. Features of the row alone are added behind the windows unless
    a window reads them. The block windows read their input more than once, so the results of the dedup
    and of the gap filter go through ``stage`` (a written table by default). Input that is stored and
    unique per series and time, like the silver table, needs no ``deduplicate``.
    """
    keys = list(keys)
    if deduplicate:
        rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, ts)]
        df = stage(dedup(df, [*keys, ts], rest))
    df = stage(drop_after_gap(df, ts, spec.max_gap_hours, keys, unique=True))

    row = spec.row_features()
    inputs = {*spec.lags, *[r.col for r in spec.rolls], *spec.diffs, *spec.velocities.values(), spec.target}
    df = df.select("*", *[e.alias(n) for n, e in row.items() if n in inputs])

    tol = int(spec.tolerance_hours * HOUR)
    name = "target_{col}_{h}h"
    df = over_blocks(
        df,
        ts,
        [
            together(
                lag_stage(spec.lags),
                roll_stage(spec.rolls),
                diff_stage(spec.diffs),
                elapsed_stage(spec.elapsed),
                velocity_stage(spec.velocities),
                lead_stage(ts, spec.next_time, spec.next_hours),
                target_stage(spec.target, spec.horizons, tol, spec.pick, name),
            ),
            acceleration_stage(spec.accelerations),
        ],
        keys,
        before=max(2, *[n for ns in spec.lags.values() for n in ns]),
        after=1,
        back_s=max(r.back_s for r in spec.rolls),
        fwd_s=max(spec.horizons) * HOUR + tol,
        width_s=width_s,
        unique=True,
        uses=sorted(inputs),
    )
    late = {n: e for n, e in row.items() if n not in inputs} | time_features(ts, spec.pi)
    df = df.select("*", *[e.alias(n) for n, e in late.items()])
    df = require_any(df, [name.format(col=spec.target, h=h) for h in spec.horizons])
    df = df.na.drop(subset=list(spec.essential))
    ordered = [*keys, *[c for c in spec.order if c in df.columns]]
    return df.select(*ordered, *[c for c in df.columns if c not in ordered])
