"""Block-partitioned windows against plain ones, and the semantics of lags, gaps and targets."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.operators.blocks import HOUR
from seriesloom.operators.gaps import after_event, stoppages
from seriesloom.operators.windows import (
    Roll,
    acceleration,
    diff_features,
    drop_after_gap,
    elapsed_hours,
    horizon_targets,
    lag_features,
    lead_gap,
    rolling,
)

T0 = datetime(2024, 1, 1)
SCHEMA = "k int, id int, ts timestamp_ntz, v double"


def series(spark, hours, values=None, k=0):
    values = values if values is not None else [float(i) for i in range(len(hours))]
    rows = [(k, i, T0 + timedelta(hours=h), v) for i, (h, v) in enumerate(zip(hours, values))]
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, *cols):
    return [tuple(r) for r in df.orderBy("id").select(*cols).collect()]


def test_targets_take_the_last_value_of_the_frame(spark):
    df = horizon_targets(series(spark, range(12)), "ts", "v")
    row = df.where("id = 0").first()
    assert [row[f"target_v_{h}h"] for h in (2, 4, 6, 8)] == [3.0, 5.0, 7.0, 9.0]
    assert df.where("id = 11").first()["target_v_2h"] is None


def test_targets_nearest(spark):
    df = horizon_targets(series(spark, [0, 1, 2, 3, 4.5, 6]), "ts", "v", (2,), pick="nearest")
    assert by_id(df, "target_v_2h") == [(2.0,), (3.0,), (4.0,), (4.0,), (5.0,), (None,)]


def test_gap_filter_drops_the_row_after_the_gap(spark):
    df = series(spark, [0, 1, 7, 12.99, 73, 74])
    kept = drop_after_gap(df, "ts", 6.0)
    assert [r[0] for r in by_id(kept, "id")] == [0, 1, 3, 5]
    again = elapsed_hours(kept, "ts")
    assert by_id(again.select("id", F.round("delta_t_hours", 2).alias("d")), "d") == [(None,), (1.0,), (11.99,), (61.01,)]


def test_row_lags_cross_empty_blocks(spark):
    df = series(spark, [0, 1, 5000, 5001, 20000])
    out = lag_features(df, "ts", {"v": [1, 3]}, width_s=HOUR)
    assert by_id(out, "v_lag_1h", "v_lag_3h") == [(None, None), (0.0, None), (1.0, None), (2.0, 0.0), (3.0, 1.0)]


def test_acceleration_needs_two_earlier_rows(spark):
    out = acceleration(series(spark, [0, 1, 2], [0.0, 1.0, 3.0]), "ts", {"v": "v"})
    rows = by_id(out, "v_velocity", "v_acceleration")
    assert rows[0] == (None, None) and rows[1][1] is None
    assert rows[2][1] == pytest.approx(1.0, abs=1e-3)


def test_zero_denominator_gives_null(spark):
    out = diff_features(series(spark, [0, 1, 2], [-1e-5, 1.0, 2.0]), "ts", ["v"])
    assert by_id(out, "v_diff_pct")[1] == (None,)


def test_single_row(spark):
    df = series(spark, [0])
    out = rolling(df, "ts", [Roll("s", "v", "stddev", HOUR), Roll("m", "v", "avg", HOUR)])
    assert by_id(out, "s", "m") == [(None, 0.0)]
    assert by_id(lead_gap(df, "ts"), "next_ts", "hours_to_next") == [(None, None)]


def test_stoppages_and_following_rows(spark):
    df = series(spark, [0, 60, 61, 130, 131, 132, 133], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0])
    stops = stoppages(df, "ts", "v", 50)
    assert [(r["value_before"], r["value_delta"]) for r in stops.orderBy("stop_start").collect()] == [
        (1.0, 1.0),
        (3.0, 1.0),
    ]
    after = after_event(df, "ts", "hours_to_next > 50", 3).orderBy("event_ts", "position")
    # the second gap lies within three rows of the first, so rows appear once per gap
    assert [(r["position"], r["v"]) for r in after.collect()] == [
        (0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0), (0, 3.0), (1, 4.0), (2, 5.0), (3, 6.0),
    ]


FNS = ["avg", "stddev", "sum", "count", "min", "max"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 40 * 3600), st.one_of(st.none(), st.integers(-50, 50))),
        min_size=1,
        max_size=60,
    )
)
def test_rolling_equals_plain_window(spark, rows):
    data = [(k, i, T0 + timedelta(seconds=s), None if v is None else float(v)) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    got = rolling(df, "ts", [Roll(f, "v", f, 4 * HOUR) for f in FNS], ["k"])
    w = Window.partitionBy("k").orderBy(F.unix_timestamp("ts")).rangeBetween(-4 * HOUR, 0)
    fns = {"avg": F.avg, "stddev": F.stddev_samp, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    want = df.select("*", *[fns[f]("v").over(w).alias(f) for f in FNS])
    for a, b in zip(by_id(got, *FNS), by_id(want, *FNS)):
        assert a == pytest.approx(b, abs=1e-9, nan_ok=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 2), st.integers(0, 10**6)), min_size=1, max_size=60),
    st.sampled_from([None, 1, 5]),
)
def test_lags_and_leads_equal_plain_window(spark, rows, max_rows):
    data = [(k, i, T0 + timedelta(seconds=s), float(i)) for i, (k, s) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    w = Window.partitionBy("k").orderBy("ts", "id")
    got = lag_features(df, "ts", {"v": [1, 4]}, ["k"], ["id"], width_s=6 * HOUR, max_rows=max_rows)
    want = df.select("id", F.lag("v", 1).over(w), F.lag("v", 4).over(w))
    assert by_id(got, "v_lag_1h", "v_lag_4h") == [tuple(r)[1:] for r in want.orderBy("id").collect()]
    ahead = lead_gap(df, "ts", ["k"], ["id"], width_s=6 * HOUR, max_rows=max_rows)
    assert by_id(ahead, "next_ts") == [tuple(r) for r in df.select("id", F.lead("ts").over(w).alias("n")).orderBy("id").select("n").collect()]


def test_hot_series_is_split(spark):
    """A third of the rows in one series and minute: its block is cut, the answers stay the same."""
    data = [(0, i, T0 + timedelta(milliseconds=10 * i), float(i)) for i in range(3000)]
    data += [(k, 3000 + k, T0 + timedelta(minutes=k), float(k)) for k in range(1, 6001)]
    df = spark.createDataFrame(data, SCHEMA)
    w = Window.partitionBy("k").orderBy("ts", "id")
    got = lag_features(df, "ts", {"v": [1, 2]}, ["k"], ["id"], max_rows=200)
    want = df.select("id", F.lag("v", 1).over(w), F.lag("v", 2).over(w)).orderBy("id").collect()
    assert by_id(got, "v_lag_1h", "v_lag_2h") == [tuple(r)[1:] for r in want]


@pytest.mark.parametrize("max_rows", [3, 40])
def test_deep_cuts_and_rows_without_a_time(spark, max_rows):
    """Bursts a microsecond apart beside long pauses; lags over many parts; rows without a time stay."""
    at = [timedelta(days=40 * d, microseconds=us) for d in (0, 1, 30) for us in range(60)]
    data = [(i % 2, i, T0 + t, float(i)) for i, t in enumerate(at)] + [(0, 900 + i, None, 1.0) for i in range(5)]
    df = spark.createDataFrame(data, SCHEMA)
    w = Window.partitionBy("k").orderBy("ts", "id")
    got = lag_features(df, "ts", {"v": [1, 12]}, ["k"], ["id"], max_rows=max_rows)
    timed = df.where("ts is not null")
    want = timed.select("id", F.lag("v", 1).over(w).alias("a"), F.lag("v", 12).over(w).alias("b")).orderBy("id")
    assert by_id(got.where("ts is not null"), "v_lag_1h", "v_lag_12h") == [(r["a"], r["b"]) for r in want.collect()]
    assert by_id(got.where("ts is null"), "v_lag_1h", "v_lag_12h") == [(None, None)] * 5
    ahead = lead_gap(df, "ts", ["k"], ["id"], max_rows=max_rows)
    later = timed.select("id", F.lead("ts").over(w).alias("n")).orderBy("id").select("n").collect()
    assert by_id(ahead.where("ts is not null"), "next_ts") == [tuple(r) for r in later]


def test_no_window_over_a_cut_series(spark):
    """What a task of the carry step holds is set by the fan of a cut, not by the number of blocks."""
    from seriesloom.operators import blocks

    data = [(0, i, T0 + timedelta(milliseconds=10 * i), float(i)) for i in range(6000)]
    df = spark.createDataFrame(data, SCHEMA)
    us = blocks.epoch_us("ts")
    cut, hot = blocks.assign_blocks(df, us, ["k"], blocks.WIDE, 100)
    sizes = [r["count"] for r in cut.groupBy("_block").count().collect()]
    assert max(sizes) <= 100 and len(sizes) <= 6000 / (100 / blocks._FAN)
    for level in range(len(hot.levels)):
        parts = cut.select(F.get("_levels", F.lit(level)).alias("a"), F.get("_levels", F.lit(level + 1)).alias("b"))
        most = parts.distinct().groupBy("a").count().agg(F.max("count")).first()[0]
        assert most <= blocks._FAN
