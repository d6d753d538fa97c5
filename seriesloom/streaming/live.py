"""Stateful streaming: resampling, joins on the grain, dedup and feature refresh, all bounded by watermarks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_dedup(
    sdf: DataFrame, ts: str, keys: Sequence[str], watermark: str = "1 hour"
) -> DataFrame:
    """Drop repeats of ``keys`` that arrive within the watermark delay."""
    return sdf.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def stream_resample(
    sdf: DataFrame,
    ts: str,
    grain: str,
    aggs: Mapping[str, str],
    watermark: str = "1 hour",
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per series and window of length ``grain``, emitted when the watermark passes its end."""
    exprs = [getattr(F, fn)(c).alias(c) for c, fn in aggs.items()]
    return sdf.withWatermark(ts, watermark).groupBy(F.window(ts, grain), *keys).agg(*exprs)


def window_start(df: DataFrame, out: str) -> DataFrame:
    """Replace the window of a resampled stream by its start."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias(out), *rest)


def stream_join_on_grain(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Inner join of two resampled streams on their windows; state is dropped with the watermark."""
    return left.join(right, ["window", *keys], "inner")


def stream_refresh(
    sdf: DataFrame, ts: str, cols: Sequence[str], keys: Sequence[str], watermark: str = "1 hour"
) -> DataFrame:
    """Row lag, difference, velocity and acceleration of each column, computed as rows arrive.

    A row is emitted once the watermark has passed it, in time order per series, so late and shuffled
    input gives the result of the batch operators. Per series the state holds the rows inside the
    watermark delay and two earlier values per column. A series is handled by one task per micro-batch,
    so the rate limit of the source bounds what a hot series brings there.
    """
    cols, keys = list(cols), list(keys)
    kind = {f.name: f.dataType for f in sdf.schema.fields}
    out = T.StructType(
        [T.StructField(k, kind[k]) for k in keys]
        + [T.StructField(ts, T.TimestampType())]
        + [
            T.StructField(name, T.DoubleType())
            for c in cols
            for name in (c, f"{c}_lag_1h", f"{c}_diff_1h", f"{c}_velocity", f"{c}_acceleration")
        ]
    )
    state_type = "us array<bigint>, v array<array<double>>, last_us bigint, last_v array<double>, last_vel array<double>"
    eps = 1e-5

    def emit(key: tuple, ready: list[tuple[int, list]], last: tuple) -> tuple[pd.DataFrame, tuple]:
        last_us, last_v, last_vel = last
        rows: list[list[Any]] = []
        for us, v in ready:
            row: list[Any] = [*key, pd.Timestamp(us, unit="us")]
            velocity = []
            for i, x in enumerate(v):
                before = last_v[i] if last_us is not None else np.nan
                hours = (us // 1_000_000 - last_us // 1_000_000) / 3600.0 + eps if last_us is not None else np.nan
                speed = (x - before) / hours
                velocity.append(speed)
                row += [x, before, x - before, speed, (speed - last_vel[i]) / hours]
            rows.append(row)
            last_us, last_v, last_vel = us, v, velocity
        frame = pd.DataFrame(rows, columns=out.fieldNames())
        return frame, (last_us, last_v, last_vel)

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            us, v, last_us, last_v, last_vel = state.get
            waiting = list(zip(us, [list(x) for x in v]))
            last = (last_us, list(last_v), list(last_vel))
        else:
            waiting, last = [], (None, [np.nan] * len(cols), [np.nan] * len(cols))
        for pdf in batches:
            stamps = pdf[ts].astype("datetime64[us]").astype("int64")
            waiting += list(zip(stamps.tolist(), pdf[cols].astype(float).to_numpy().tolist()))
        mark = state.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda r: r[0])
        # a row older than one already emitted came after the watermark had passed it: too late
        ready = [r for r in waiting if r[0] <= mark and (last[0] is None or r[0] >= last[0])]
        waiting = [r for r in waiting if r[0] > mark]
        frame, last = emit(key, ready, last)
        state.update(([r[0] for r in waiting], [r[1] for r in waiting], last[0], list(last[1]), list(last[2])))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000, mark // 1000) + 1)
        if len(frame):
            yield frame

    marked = sdf.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (
        marked.select(*keys, ts, *cols)
        .groupBy(*keys)
        .applyInPandasWithState(step, out, state_type, "append", GroupStateTimeout.EventTimeTimeout)
    )
