"""Joins, unions, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import asof_drift, asof_join
from ..operators.dedup import first_per, head_n, tail_n, top_k, union_tagged
from ..operators.quality import broadcast_row
from ..operators.resample import join_on_grain, resample
from ..operators.serving import serve_features
from .base import query, round_all, rounded_sql, table


def _pair(spark, sf):
    ev = table(spark, sf, "events")
    left = ev.where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    right = ev.where("event_type = 'error'").select(
        "user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"), F.col("value").alias("r_value")
    )
    return left, right


_L = "l as (select user_id, event_id, ts from events where event_type = 'purchase')"
_R = "r as (select user_id, event_id as r_id, ts as r_ts, value as r_value from events where event_type = 'error')"
_OUT = "l.event_id, l.user_id, l.ts, r_id, r_ts, r_value"


@query(
    "asof_backward",
    f"with {_L}, {_R} select {_OUT} from l asof left join r on l.user_id = r.user_id and l.ts >= r.r_ts",
)
def asof_backward(spark, sf):
    left, right = _pair(spark, sf)
    return asof_join(left, right, "ts", "r_ts", ["user_id"], tie=["r_id"])


@query("asof_single_series", f"with {_L}, {_R} select {_OUT} from l asof left join r on l.ts >= r.r_ts")
def asof_single(spark, sf):
    left, right = _pair(spark, sf)
    return asof_join(left, right.drop("user_id"), "ts", "r_ts", tie=["r_id"])


@query(
    "asof_forward",
    f"with {_L}, {_R} select {_OUT} from l asof left join r on l.user_id = r.user_id and l.ts <= r.r_ts",
)
def asof_forward(spark, sf):
    left, right = _pair(spark, sf)
    return asof_join(left, right, "ts", "r_ts", ["user_id"], direction="forward", tie=["r_id"])


@query(
    "asof_nearest",
    f"""with {_L}, {_R}, m as (select {_OUT}, row_number() over (partition by l.event_id
  order by abs(epoch_us(l.ts) - epoch_us(r_ts)) nulls last, r_ts) as k from l left join r on l.user_id = r.user_id)
select event_id, user_id, ts, r_id, r_ts, r_value from m where k = 1""",
)
def asof_nearest(spark, sf):
    left, right = _pair(spark, sf)
    return asof_join(left, right, "ts", "r_ts", ["user_id"], direction="nearest", tie=["r_id"])


@query(
    "asof_tolerance",
    f"""with {_L}, {_R}, m as (select {_OUT} from l asof left join r on l.user_id = r.user_id and l.ts >= r.r_ts)
select event_id, case when epoch_us(ts) - epoch_us(r_ts) <= 86400000000 then r_id end as r_id from m""",
)
def asof_tolerance(spark, sf):
    left, right = _pair(spark, sf)
    df = asof_join(left, right, "ts", "r_ts", ["user_id"], tolerance_s=86400, tie=["r_id"])
    return df.select("event_id", "r_id")


@query(
    "asof_drift",
    f"""with {_L}, {_R} select event_id, {rounded_sql("(epoch_us(ts) - epoch_us(r_ts)) / 60e6", 4)} as drift_min
from l asof left join r on l.user_id = r.user_id and l.ts >= r.r_ts""",
)
def drift_minutes(spark, sf):
    left, right = _pair(spark, sf)
    df = asof_drift(asof_join(left, right, "ts", "r_ts", ["user_id"], tie=["r_id"]), "ts", "r_ts")
    return round_all(df.select("event_id", "drift_min"), ["drift_min"], 4)


@query(
    "join_on_hour",
    f"""with a as (select date_trunc('hour', ts) as hour, avg(value) as mean_value from events group by 1),
b as (select date_trunc('hour', ts) as hour, event_id, value as target from events where event_type = 'purchase'
  qualify row_number() over (partition by date_trunc('hour', ts) order by ts desc, event_id desc) = 1)
select cast(hour as timestamp) as hour, {rounded_sql('mean_value')} as mean_value, event_id, target from a join b using (hour)""",
)
def join_on_hour(spark, sf):
    ev = table(spark, sf, "events")
    hourly = resample(ev, "ts", "hour", {"value": "avg"}).withColumnRenamed("value", "mean_value")
    latest = first_per(
        ev.where("event_type = 'purchase'").withColumn("h", F.date_trunc("hour", "ts")),
        ["h"],
        [F.col("ts").desc(), F.col("event_id").desc()],
    ).select(F.col("ts").alias("t"), "event_id", F.col("value").alias("target"))
    joined = join_on_grain(hourly, latest, "ts", "t", "hour", out="hour")
    return round_all(joined, ["mean_value"])


@query(
    "broadcast_statistics",
    f"""with s as (select avg(value) as m, max(value) as top from events)
select event_id, {rounded_sql('value - m')} as above_mean, {rounded_sql('value / top')} as share from events, s""",
)
def broadcast_statistics(spark, sf):
    ev = table(spark, sf, "events")
    stats = ev.agg(F.avg("value").alias("m"), F.max("value").alias("top"))
    df = broadcast_row(ev, stats, "s").select(
        "event_id",
        (F.col("value") - F.col("s.m")).alias("above_mean"),
        (F.col("value") / F.col("s.top")).alias("share"),
    )
    return round_all(df, ["above_mean", "share"])


_LATEST = "h as (select * from events where event_type <> 'signup'), n as (select * from events where event_type = 'signup')"


def _serve_sql(keyed: bool) -> str:
    last = "arg_max(h, struct_pack(ts := ts, e := event_id)) as last"
    source = (
        f"select user_id as k, {last} from h group by user_id" if keyed else f"select {last} from h"
    )
    on = "left join g on n.user_id = g.k" if keyed else ", g"
    sec = "(epoch_us(n.ts) // 1000000 - epoch_us(last.ts) // 1000000) / 3600e0"
    return f"""with {_LATEST}, g as ({source})
select n.event_id, last.event_id as last_id, last.value as value_lag_1h,
  {rounded_sql("n.value - last.value")} as value_diff_1h,
  {rounded_sql("(n.value - last.value) / nullif(last.value + 1e-5, 0)", 4)} as value_diff_pct,
  {rounded_sql(f"(n.value - last.value) / nullif({sec} + 1e-5, 0)", 4)} as value_velocity from n {on}"""


def _served(spark, sf, keys):
    ev = table(spark, sf, "events")
    history = ev.where("event_type <> 'signup'").withColumn("last_id", F.col("event_id"))
    incoming = ev.where("event_type = 'signup'")
    df = serve_features(history, incoming, "ts", ["value"], ["last_id"], keys, tie=["event_id"])
    cols = {"value_diff_1h": 6, "value_diff_pct": 4, "value_velocity": 4}
    return round_all(df.select("event_id", "last_id", "value_lag_1h", *cols), cols)


@query("serve_features", _serve_sql(True))
def serve_keyed(spark, sf):
    return _served(spark, sf, ["user_id"])


@query("serve_features_single_series", _serve_sql(False))
def serve_single(spark, sf):
    return _served(spark, sf, [])


@query("first_rows", "select event_id, ts, value from events order by ts, event_id limit 5")
def first_rows(spark, sf):
    return head_n(table(spark, sf, "events").select("event_id", "ts", "value"), 5, ["ts", "event_id"])


@query("last_rows", "select event_id, ts, value from events order by ts desc, event_id desc limit 5")
def last_rows(spark, sf):
    return tail_n(table(spark, sf, "events").select("event_id", "ts", "value"), 5, ["ts", "event_id"])


@query("sort_by_time", "select event_id, ts from events order by ts, event_id")
def sort_by_time(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts").orderBy("ts", "event_id")


@query(
    "top_k",
    f"select p_type, {rounded_sql('avg(p_retailprice)', 4)} as price from part group by 1 order by avg(p_retailprice) desc, p_type limit 10",
)
def top_types(spark, sf):
    df = table(spark, sf, "part").groupBy("p_type").agg(F.avg("p_retailprice").alias("price"))
    return round_all(top_k(df, "price", 10, ["p_type"]), ["price"], 4)


@query(
    "union_tagged",
    """select event_id, value, null::varchar as note, 'first' as source_type from events where event_type in ('click', 'purchase')
union all select event_id, null, event_type, 'second' from events where event_type not in ('click', 'purchase')""",
)
def tagged(spark, sf):
    ev = table(spark, sf, "events")
    measured = F.col("event_type").isin("click", "purchase")
    return union_tagged(
        {
            "first": ev.where(measured).select("event_id", "value"),
            "second": ev.where(~measured).select("event_id", F.col("event_type").alias("note")),
        }
    )


@query(
    "project_rename_drop",
    "select o_orderkey as order_id, o_totalprice as amount, o_orderdate from orders",
)
def project(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return df.withColumnsRenamed({"o_orderkey": "order_id", "o_totalprice": "amount"}).drop("o_orderstatus")


@query(
    "resample_hourly",
    f"""select user_id % 5 as line, cast(date_trunc('hour', ts) as timestamp) as ts, {rounded_sql('avg(value)')} as value,
  max(event_id) as event_id from events group by 1, 2""",
)
def resample_hourly(spark, sf):
    df = table(spark, sf, "events").withColumn("line", F.expr("user_id % 5"))
    return round_all(resample(df, "ts", "hour", {"value": "avg", "event_id": "max"}, ["line"]), ["value"])
