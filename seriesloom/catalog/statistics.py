"""Counts, distributions, correlations, health, forecast metrics and drift."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.resample import resample
from ..operators.stats import (
    corr,
    corr_matrix,
    describe,
    drift,
    forecast_metrics,
    health,
    naive_forecast,
    rank_by_corr,
    summarize,
)
from ..operators.blocks import HOUR
from ..operators.windows import horizon_targets
from ..plans.audit import Layer, audit
from ..plans.monitoring import update_drift_history
from ..sources.staging import stage_folder
from .base import query, round_all, rounded_sql, table

COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEC = "epoch_us(ts) // 1000000"


@query("row_count", "select count(*) as n from lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def _union(cells: list[str]) -> str:
    return " union all ".join(f"select {c}" for c in cells)


@query(
    "five_numbers",
    _union(
        [
            f"'{c}' as \"column\", {p}e0 as prob, (select {rounded_sql(f'quantile_cont({c}, {p})')} from lineitem) as value"
            for c in COLS
            for p in (0.0, 0.25, 0.5, 0.75, 1.0)
        ]
    ),
)
def five_numbers(spark, sf):
    return round_all(summarize(table(spark, sf, "lineitem"), COLS), ["value"])


_PROBS = [0.01, 0.02, 0.05, 0.5, 0.95, 0.98, 0.99]
_DESCRIBED = {"mean": 4, "std": 4, "min": 4, "max": 4, **{f"p{p * 100:g}": 4 for p in _PROBS}}


@query(
    "describe",
    _union(
        [
            f"""'{c}' as "column", count({c}) as "count", {rounded_sql(f'avg({c})', 4)} as mean,
  {rounded_sql(f'stddev_samp({c})', 4)} as std, {rounded_sql(f'min({c})', 4)} as min, {rounded_sql(f'max({c})', 4)} as max, """
            + ", ".join(f"{rounded_sql(f'quantile_cont({c}, {p})', 4)} as p{p * 100:g}" for p in _PROBS)
            + " from lineitem"
            for c in COLS
        ]
    ),
)
def describe_columns(spark, sf):
    return round_all(describe(table(spark, sf, "lineitem"), COLS, _PROBS), _DESCRIBED)


@query("correlation", f"select {rounded_sql('corr(l_quantity, l_extendedprice)')} as corr from lineitem")
def correlation(spark, sf):
    return round_all(corr(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), ["corr"])


@query(
    "correlation_matrix",
    _union(
        [
            f"'{a}' as a, '{b}' as b, (select {rounded_sql(f'corr({a}, {b})')} from lineitem) as corr"
            for a in COLS
            for b in COLS
        ]
    ),
)
def correlation_matrix(spark, sf):
    return round_all(corr_matrix(table(spark, sf, "lineitem"), COLS), ["corr"])


@query(
    "correlation_ranking",
    _union(
        [
            f"'{c}' as \"column\", (select {rounded_sql(f'corr({c}, l_extendedprice)')} from lineitem) as corr"
            for c in COLS
            if c != "l_extendedprice"
        ]
    ),
)
def correlation_ranking(spark, sf):
    return round_all(rank_by_corr(table(spark, sf, "lineitem"), "l_extendedprice", COLS), ["corr"])


@query(
    "health",
    f"""with h as (select count(*) as total, count(*) filter (value > 200) as anomalies from events)
select total, anomalies, {rounded_sql("anomalies / total")} as anomaly_rate,
  {rounded_sql("(1 - anomalies / total) * 100")} as health_pct from h""",
)
def health_report(spark, sf):
    df = table(spark, sf, "events").withColumn("flag", F.expr("case when value > 200 then -1 else 1 end"))
    return round_all(health(df, "flag"), ["anomaly_rate", "health_pct"])


_METRICS = {"mae": 6, "rmse": 6, "r2": 6, "naive_mae": 6, "improvement_pct": 4}
_FORECAST = f"""with hourly as (select date_trunc('hour', ts) as ts, avg(value) as value from events group by 1),
t as (select *, {', '.join(f"last_value(value ignore nulls) over (order by {SEC} range between {int((h - 1.5) * HOUR)} following and {int((h + 1.5) * HOUR)} following) as t{h}" for h in (2, 4, 6, 8))} from hourly),
f as ({' union all '.join(f"select {h} as horizon_hours, value * 5e-1 + 25e0 as pred, value as naive, t{h} as actual from t where t{h} is not null" for h in (2, 4, 6, 8))}),
m as (select cast(horizon_hours as integer) as horizon_hours, count(*) as n, avg(abs(pred - actual)) as mae,
  sqrt(avg((pred - actual) * (pred - actual))) as rmse,
  1 - sum((pred - actual) * (pred - actual)) / (var_pop(actual) * count(*)) as r2,
  avg(abs(naive - actual)) as naive_mae from f group by 1)
select horizon_hours, n, {', '.join(f"{rounded_sql(c)} as {c}" for c in ('mae', 'rmse', 'r2', 'naive_mae'))},
  {rounded_sql("(naive_mae - mae) / naive_mae * 100", 4)} as improvement_pct from m"""


@query("forecast_metrics", _FORECAST)
def metrics(spark, sf):
    hourly = resample(table(spark, sf, "events"), "ts", "hour", {"value": "avg"})
    df = horizon_targets(naive_forecast(hourly, "value"), "ts", "value")
    df = df.withColumn("pred", F.expr("value * 5e-1 + 25e0"))
    cells = [
        F.struct(F.lit(h).alias("horizon_hours"), F.col(f"target_value_{h}h").alias("actual")) for h in (2, 4, 6, 8)
    ]
    long = df.select("pred", "naive", F.inline(F.array(*cells)))
    return round_all(forecast_metrics(long, "pred", "actual", "naive", ["horizon_hours"]), _METRICS)


@query(
    "drift_monitor",
    f"""with e as (select event_id, {SEC} as s, abs(50e0 - value) as abs_err from events),
r as (select event_id, avg(abs_err) over (order by s range between 604800 preceding and current row) as m from e)
select event_id, {rounded_sql('m')} as rolling_mae,
  cast(case when m > 4e1 or m > 28e0 * 125e-2 then 1 else 0 end as integer) as drift from r""",
)
def drift_monitor(spark, sf):
    df = table(spark, sf, "events").withColumn("pred", F.lit(50.0))
    df = drift(df, "ts", "pred", "value", baseline_mae=28.0, abs_limit=40.0, rel=0.25)
    return round_all(df.select("event_id", "rolling_mae", "drift"), ["rolling_mae"])


@query(
    "drift_history",
    f"""with e as (select event_id, {SEC} as s, strftime(ts, '%Y-%m-%d') as day, abs(50e0 - value) as abs_err from events),
r as (select event_id, day, avg(abs_err) over (order by s range between 604800 preceding and current row) as m from e)
select event_id, day, {rounded_sql('m')} as rolling_mae,
  cast(case when m > 4e1 or m > 28e0 * 125e-2 then 1 else 0 end as integer) as drift from r""",
)
def drift_history(spark, sf):
    """Two increments, the second repeated: the first ends in the middle of a day."""
    df = table(spark, sf, "events").withColumn("pred", F.lit(50.0))
    path = f"{stage_folder(spark)}/drift-{uuid.uuid4().hex}"
    ends = df.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    for part in (df.where(F.col("ts") < ends["a"] + (ends["b"] - ends["a"]) / 2), df, df):
        history = update_drift_history(part, path, "ts", "pred", "value", baseline_mae=28.0, abs_limit=40.0)
    return round_all(history.select("event_id", F.col("day").cast("string"), "rolling_mae", "drift"), ["rolling_mae"])


def _layer_sql(name: str, source: str, columns: int, value: str, part: str, order: str) -> str:
    gap = f"(lead({SEC}) over ({part} order by {order}) - {SEC}) / 3600e0"
    cells = [
        "'rows' as metric, count(*)::double as value from t",
        f"'columns', {columns}e0",
        f"'first_s', min({SEC})::double from t",
        f"'last_s', max({SEC})::double from t",
    ]
    for p in (0, 25, 50, 75, 100):
        cells.append(f"'value_p{p}', quantile_cont({value}, {p / 100}) from t")
        cells.append(f"'hours_p{p}', quantile_cont(g, {p / 100}) from (select {gap} as g from t)")
    return f"(with t as ({source}) select '{name}' as layer, metric, {rounded_sql('value')} as value from ({_union(cells)}))"


@query(
    "layer_audit",
    _layer_sql("raw", "select * from events", 6, "value", "partition by user_id", "ts, event_id")
    + " union all "
    + _layer_sql("hourly", "select date_trunc('hour', ts) as ts, avg(value) as value from events group by 1", 2, "value", "", "ts"),
)
def layer_audit(spark, sf):
    ev = table(spark, sf, "events")
    hourly = resample(ev, "ts", "hour", {"value": "avg"})
    report = audit(
        {"raw": Layer(ev, "ts", "value", ["user_id"], ["event_id"]), "hourly": Layer(hourly, "ts", "value")}
    )
    return round_all(report, ["value"])
