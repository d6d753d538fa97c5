"""Windowed features, gaps and targets on event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.blocks import DAY, HOUR
from ..operators.dedup import dedup, first_per
from ..operators.gaps import after_event, interval_stats, stoppages
from ..operators.resample import resample
from ..operators.windows import (
    Roll,
    acceleration,
    diff_features,
    drop_after_gap,
    elapsed_hours,
    horizon_targets,
    lag_features,
    lead_gap,
    rolling,
    velocity,
)
from .base import query, round_all, rounded_sql, table

USER = ["user_id"]
TIE = ["event_id"]
SEC = "epoch_us(ts) // 1000000"
W = "(partition by user_id order by ts, event_id)"
HOURLY_SQL = "hourly as (select date_trunc('hour', ts) as ts, avg(value) as value from events group by 1)"
USER_HOURLY_SQL = (
    "hourly as (select user_id, date_trunc('hour', ts) as ts, avg(value) as value from events group by 1, 2)"
)


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


def _hourly(spark, sf):
    return resample(table(spark, sf, "events"), "ts", "hour", {"value": "avg"})


def _user_hourly(spark, sf):
    return resample(table(spark, sf, "events"), "ts", "hour", {"value": "avg"}, USER)


def _range(back_s: int, part: str = "") -> str:
    return f"({part} order by {SEC} range between {back_s} preceding and current row)"


@query(
    "hourly_rolling",
    f"with {HOURLY_SQL} select cast(ts as timestamp) as ts, {rounded_sql('value')} as value, "
    f"{rounded_sql(f'avg(value) over {_range(4 * HOUR)}')} as mean_4h, "
    f"({SEC} - lag({SEC}) over (order by ts)) / 3600e0 as delta_h from hourly",
)
def hourly_rolling(spark, sf):
    df = rolling(_hourly(spark, sf), "ts", [Roll("mean_4h", "value", "avg", 4 * HOUR)], unique=True)
    df = elapsed_hours(df, "ts", out="delta_h", unique=True)
    return round_all(df, ["value", "mean_4h"])


@query(
    "row_lags",
    f"select event_id, user_id, ts, {', '.join(f'lag(value, {n}) over w as value_lag_{n}h' for n in (1, 2, 3, 4, 8, 12))} "
    f"from events window w as {W}",
)
def row_lags(spark, sf):
    return lag_features(_events(spark, sf), "ts", {"value": [1, 2, 3, 4, 8, 12]}, USER, TIE).drop("value")


@query(
    "row_lags_single_series",
    "select event_id, ts, lag(value, 1) over w as value_lag_1h, lag(value, 4) over w as value_lag_4h "
    "from events window w as (order by ts, event_id)",
)
def row_lags_single_series(spark, sf):
    df = lag_features(_events(spark, sf), "ts", {"value": [1, 4]}, tie=TIE, width_s=DAY)
    return df.drop("value", "user_id")


_ROLLS = {"mean_4h": ("avg", 4), "mean_8h": ("avg", 8), "mean_24h": ("avg", 24), "max_24h": ("max", 24)}
_PART = "partition by user_id"


@query(
    "rolling_means",
    "select event_id, "
    + ", ".join(
        f"{rounded_sql(f'{fn}(value) over {_range(h * HOUR, _PART)}')} as {out}" for out, (fn, h) in _ROLLS.items()
    )
    + " from events",
)
def rolling_means(spark, sf):
    rolls = [Roll(out, "value", fn, h * HOUR) for out, (fn, h) in _ROLLS.items()]
    df = rolling(_events(spark, sf), "ts", rolls, USER, TIE)
    return round_all(df.select("event_id", *_ROLLS), list(_ROLLS))


@query(
    "rolling_std",
    f"select event_id, {rounded_sql(f'stddev_samp(value) over {_range(HOUR)}')} as std_1h, "
    f"{rounded_sql(f'stddev_samp(value) over {_range(4 * HOUR)}')} as std_4h, "
    f"count(value) over {_range(4 * HOUR)} as n_4h from events",
)
def rolling_std(spark, sf):
    rolls = [
        Roll("std_1h", "value", "stddev", HOUR),
        Roll("std_4h", "value", "stddev", 4 * HOUR),
        Roll("n_4h", "value", "count", 4 * HOUR),
    ]
    df = rolling(_events(spark, sf), "ts", rolls, tie=TIE)
    return round_all(df.select("event_id", "std_1h", "std_4h", "n_4h"), ["std_1h", "std_4h"])


@query(
    "rolling_derived",
    f"select event_id, {rounded_sql(f'avg(abs(value - 50e0) / (event_id % 7 + 1)) over {_range(4 * HOUR)}')} as trend_4h "
    "from events",
)
def rolling_derived(spark, sf):
    df = _events(spark, sf).withColumn("spread", F.expr("abs(value - 50e0) / (event_id % 7 + 1)"))
    df = rolling(df, "ts", [Roll("trend_4h", "spread", "avg", 4 * HOUR)])
    return round_all(df.select("event_id", "trend_4h"), ["trend_4h"])


@query(
    "differences",
    f"""select event_id, {rounded_sql("value - lag(value) over w")} as value_diff_1h,
  {rounded_sql("(value - lag(value) over w) / nullif(lag(value) over w + 1e-5, 0)")} as value_diff_pct
from events window w as {W}""",
)
def differences(spark, sf):
    df = diff_features(_events(spark, sf), "ts", ["value"], USER, TIE)
    cols = ["value_diff_1h", "value_diff_pct"]
    return round_all(df.select("event_id", *cols), cols)


@query("elapsed", f"select event_id, ({SEC} - lag({SEC}) over w) / 3600e0 as delta_t_hours from events window w as {W}")
def elapsed(spark, sf):
    return elapsed_hours(_events(spark, sf), "ts", USER, TIE).select("event_id", "delta_t_hours")


_VEL = f"""with v as (select event_id, user_id, ts, ({SEC} - lag({SEC}) over w) / 3600e0 as h,
  (value - lag(value) over w) / nullif(({SEC} - lag({SEC}) over w) / 3600e0 + 1e-5, 0) as value_velocity
  from events window w as {W})"""


@query("velocity", f"{_VEL} select event_id, {rounded_sql('value_velocity', 4)} as value_velocity from v")
def value_velocity(spark, sf):
    df = velocity(_events(spark, sf), "ts", {"value": "value"}, USER, TIE)
    return round_all(df.select("event_id", "value_velocity"), ["value_velocity"], 4)


_ACC = "(value_velocity - lag(value_velocity) over w) / nullif(h + 1e-5, 0)"


@query(
    "acceleration",
    f"{_VEL} select event_id, {rounded_sql(_ACC, 2)} as value_acceleration from v window w as {W}",
)
def value_acceleration(spark, sf):
    df = acceleration(_events(spark, sf), "ts", {"value": "value"}, USER, TIE)
    return round_all(df.select("event_id", "value_acceleration"), ["value_acceleration"], 2)


@query(
    "next_row",
    f"select event_id, lead(ts) over w as next_ts, (lead({SEC}) over w - {SEC}) / 3600e0 as hours_to_next "
    f"from events window w as {W}",
)
def next_row(spark, sf):
    return lead_gap(_events(spark, sf), "ts", USER, TIE).select("event_id", "next_ts", "hours_to_next")


@query(
    "gap_filter",
    f"select event_id, user_id, ts from events "
    f"qualify coalesce(({SEC} - lag({SEC}) over {W}) / 3600e0 < 6, true)",
)
def gap_filter(spark, sf):
    return drop_after_gap(_events(spark, sf), "ts", 6.0, USER, TIE).select("event_id", "user_id", "ts")


def _target_sql(part: str) -> str:
    return ", ".join(
        rounded_sql(
            f"last_value(value ignore nulls) over ({part} order by {SEC} range between "
            f"{int((h - 1.5) * HOUR)} following and {int((h + 1.5) * HOUR)} following)"
        )
        + f" as target_value_{h}h"
        for h in (2, 4, 6, 8)
    )


_TARGETS = [f"target_value_{h}h" for h in (2, 4, 6, 8)]


@query("horizon_targets", f"with {HOURLY_SQL} select cast(ts as timestamp) as ts, {_target_sql('')} from hourly")
def targets(spark, sf):
    return round_all(horizon_targets(_hourly(spark, sf), "ts", "value").drop("value"), _TARGETS)


@query(
    "horizon_targets_keyed",
    f"with {USER_HOURLY_SQL} select user_id, cast(ts as timestamp) as ts, {_target_sql('partition by user_id')} from hourly",
)
def targets_keyed(spark, sf):
    df = horizon_targets(_user_hourly(spark, sf), "ts", "value", keys=USER)
    return round_all(df.drop("value"), _TARGETS)


_NEAREST = ", ".join(
    rounded_sql(
        f"(select b.value from hourly b where b.user_id = a.user_id and "
        f"abs(epoch_us(b.ts) // 1000000 - epoch_us(a.ts) // 1000000 - {h * HOUR}) <= 5400 "
        f"order by abs(epoch_us(b.ts) // 1000000 - epoch_us(a.ts) // 1000000 - {h * HOUR}), b.ts limit 1)"
    )
    + f" as target_value_{h}h"
    for h in (2, 4, 6, 8)
)


@query(
    "horizon_targets_nearest",
    f"with {USER_HOURLY_SQL} select user_id, cast(ts as timestamp) as ts, {_NEAREST} from hourly a",
)
def targets_nearest(spark, sf):
    df = horizon_targets(_user_hourly(spark, sf), "ts", "value", pick="nearest", keys=USER)
    return round_all(df.drop("value"), _TARGETS)


_NEXT = f"""with n as (select *, lead(ts) over w as next_ts, (lead({SEC}) over w - {SEC}) / 3600e0 as hours_to_next,
  lead(value) over w as after_value, row_number() over w as rn from events window w as {W})"""


@query(
    "stoppages",
    f"""{_NEXT} select user_id, ts as stop_start, next_ts as stop_end, hours_to_next as stop_hours,
  value as value_before from n where hours_to_next > 50""",
)
def stops(spark, sf):
    df = stoppages(_events(spark, sf), "ts", "value", 50.0, USER, TIE)
    return df.select("user_id", "stop_start", "stop_end", "stop_hours", "value_before")


@query(
    "stoppage_shock",
    f"""{_NEXT} select user_id, ts as stop_start, {rounded_sql("after_value - value")} as value_delta
from n where hours_to_next > 50""",
)
def stoppage_shock(spark, sf):
    df = stoppages(_events(spark, sf), "ts", "value", 50.0, USER, TIE)
    return round_all(df.select("user_id", "stop_start", "value_delta"), ["value_delta"])


@query(
    "after_stoppage",
    f"""{_NEXT} select e.user_id, e.ts as event_ts, cast(r.rn - e.rn as integer) as position, r.event_id, r.ts, r.value
from n e join n r on e.user_id = r.user_id and r.rn between e.rn and e.rn + 3 where e.hours_to_next > 50""",
)
def after_stoppage(spark, sf):
    df = after_event(_events(spark, sf), "ts", "hours_to_next > 50", 3, USER, TIE)
    return df.select("user_id", "event_ts", "position", "event_id", "ts", "value")


@query(
    "interval_distribution",
    f"""{_NEXT}, p as (select unnest([0e0, 25e-2, 5e-1, 75e-2, 1e0]) as prob)
select prob, {rounded_sql("case prob when 0 then a when 25e-2 then b when 5e-1 then c when 75e-2 then d else e end")} as hours
from p, (select quantile_cont(hours_to_next, 0.0) as a, quantile_cont(hours_to_next, 0.25) as b,
  quantile_cont(hours_to_next, 0.5) as c, quantile_cont(hours_to_next, 0.75) as d,
  quantile_cont(hours_to_next, 1.0) as e from n)""",
)
def interval_distribution(spark, sf):
    return round_all(interval_stats(_events(spark, sf), "ts", USER, TIE), ["hours"])


@query(
    "first_reading_per_time",
    """select user_id, cast(date_trunc('hour', ts) as timestamp) as hour, event_type, event_id from events
qualify row_number() over (partition by user_id, date_trunc('hour', ts) order by event_type desc, event_id) = 1""",
)
def first_reading_per_time(spark, sf):
    df = table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    df = first_per(df, ["user_id", "hour"], [F.col("event_type").desc(), "event_id"])
    return df.select("user_id", "hour", "event_type", "event_id")


@query(
    "latest_per_hour",
    """select cast(date_trunc('hour', ts) as timestamp) as hour, event_id, value from events
qualify row_number() over (partition by date_trunc('hour', ts) order by ts desc, event_id desc) = 1""",
)
def latest_per_hour(spark, sf):
    df = table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    df = first_per(df, ["hour"], [F.col("ts").desc(), F.col("event_id").desc()])
    return df.select("hour", "event_id", "value")


@query(
    "dedup_by_key",
    """select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders where o_custkey is not null
and o_orderdate is not null
qualify row_number() over (partition by o_custkey, o_orderdate order by o_totalprice desc, o_orderkey) = 1""",
)
def dedup_by_key(spark, sf):
    df = dedup(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"], [F.col("o_totalprice").desc(), "o_orderkey"])
    return df.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
