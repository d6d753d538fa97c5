"""Stoppages: long gaps in a series, the value change across them and the rows that follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .blocks import Frames, over_blocks
from .quantiles import exact_quantiles
from .windows import lead_gap, lead_stage


def stoppages(
    df: DataFrame,
    ts: str,
    value: str,
    min_hours: float = 50.0,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    **blocks,
) -> DataFrame:
    """Start, length and last value of every gap longer than ``min_hours``, with the change of the
    value across the gap."""

    def ahead(f: Frames) -> dict[str, Column]:
        return {"_after": F.lead(value).over(f.rows)}

    timed = over_blocks(
        df,
        ts,
        [lead_stage(ts, "_next", "hours"), ahead],
        keys,
        tie,
        after=1,
        uses=[value],
        **blocks,
    )
    return timed.where(F.col("hours") > F.lit(float(min_hours))).select(
        *keys,
        F.col(ts).alias("stop_start"),
        F.col("_next").alias("stop_end"),
        F.col("hours").alias("stop_hours"),
        F.col(value).alias("value_before"),
        F.col("_after").alias("value_after"),
        (F.col("_after") - F.col(value)).alias("value_delta"),
    )


def after_event(
    df: DataFrame,
    ts: str,
    cond: str,
    n: int = 3,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    next_ts: str = "next_ts",
    hours: str = "hours_to_next",
    **blocks,
) -> DataFrame:
    """Each event row and the ``n`` rows after it, with the event time and the position (0 = event).

    ``cond`` may use ``hours_to_next``. A row that follows several events appears once per event.
    """

    def events(f: Frames) -> dict[str, Column]:
        hit = F.coalesce(F.expr(cond), F.lit(False))
        seen = [
            F.struct(
                F.lag(hit.cast("int"), k).over(f.rows).alias("hit"),
                F.lag(ts, k).over(f.rows).alias("event_ts"),
                F.lit(k).alias("position"),
            )
            for k in range(n + 1)
        ]
        return {"_events": F.array(*seen)}

    timed = over_blocks(
        df, ts, [lead_stage(ts, next_ts, hours), events], keys, tie, before=n, after=1, **blocks
    )
    return timed.select(
        "*", F.inline(F.filter("_events", lambda e: e["hit"] == 1))
    ).drop("_events", "hit")


def interval_stats(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
    **blocks,
) -> DataFrame:
    """Quantiles of the hours between consecutive rows, one row per probability.

    The quantiles take several passes, so the intervals are stored first."""
    timed = staged(lead_gap(df, ts, keys, tie, hours="_h", **blocks).select("_h"))
    values = exact_quantiles(timed, ["_h"], probs)["_h"]
    rows = list(zip([float(p) for p in probs], values))
    return df.sparkSession.createDataFrame(rows, "prob double, hours double")
