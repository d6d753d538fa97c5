"""Validity rules, trimming, imputation, defaults and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    cyclic,
    diff_of,
    epoch_s,
    group_cols,
    minutes_between,
    nan_to_null,
    product,
    row_max,
    row_mean,
    row_min,
    row_spread,
    safe_ratio,
    signed_fmt,
    time_parts,
    trunc,
)
from ..operators.dedup import sample_n
from ..operators.quality import (
    align_columns,
    apply_rules,
    apply_rules_each,
    check_domain,
    feature_columns,
    fill_missing,
    flag_invalid,
    funnel,
    impute,
    pool_means,
    require_any,
    rules_each,
    with_defaults,
)
from ..operators.quantiles import trim_quantiles
from ..operators.serving import classify_alert
from ..operators.stats import count_where
from ..plans.furnace import CLEANING, CONTRACT, DEFAULTS, NOT_FEATURES, TP, TRUSTED, TT, VALIDITY
from .base import SENSOR_SQL, plant_sensors, query, round_all, round_all_sql, rounded_sql, table

_VALID = " and ".join(f"({r})" for r in VALIDITY)
_FLAGGED = f"""flagged as (select *, cast(case when coalesce({_VALID}, false) then 0 else 1 end as integer) as is_outlier
  from ({SENSOR_SQL}))"""


@query("validity_flag", f"with {_FLAGGED} select event_id, is_outlier from flagged")
def validity_flag(spark, sf):
    return flag_invalid(plant_sensors(spark, sf), VALIDITY).select("event_id", "is_outlier")


def _rule_filter(step):
    sql = f"select event_id, dt from ({SENSOR_SQL}) where " + " and ".join(f"({r})" for r in step.rules)

    @query(f"rules_{step.name}", sql)
    def run(spark, sf):
        return apply_rules(plant_sensors(spark, sf), step.rules).select("event_id", "dt")


for _step in CLEANING[:3]:
    _rule_filter(_step)


@query(
    "rules_thermal",
    f"select event_id from ({SENSOR_SQL}) where "
    + " and ".join(rules_each(TT + TP, "{c} > 0 and {c} < 1000"))
    + f" and ({' + '.join(TT)}) / 4e0 < ({' + '.join(TP)}) / 10e0",
)
def rules_thermal(spark, sf):
    df = apply_rules_each(plant_sensors(spark, sf), TT + TP, "{c} > 0 and {c} < 1000")
    return df.where(row_mean(TT, skip_nulls=True) < row_mean(TP, skip_nulls=True)).select("event_id")


@query("rule_target_range", "select event_id, value / 200e0 as si from events where value / 200e0 > 15e-2 and value / 200e0 < 15e-1")
def rule_target(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.expr("value / 200e0").alias("si"))
    return apply_rules(df, ["si > 15e-2", "si < 15e-1"])


_LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_BOUNDS = ", ".join(f"quantile_cont({c}, 0.01) as lo_{c}, quantile_cont({c}, 0.99) as hi_{c}" for c in _LINE_COLS)
_INSIDE = " and ".join(f"{c} between lo_{c} and hi_{c}" for c in _LINE_COLS)


@query(
    "quantile_trim",
    f"with b as (select {_BOUNDS} from lineitem) "
    f"select l_orderkey, l_linenumber, l_extendedprice from lineitem, b where {_INSIDE}",
)
def quantile_trim(spark, sf):
    df = trim_quantiles(table(spark, sf, "lineitem"), _LINE_COLS, 0.01, 0.99)
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "quantile_trim_after_rules",
    f"with r as (select * from lineitem where l_quantity > 2 and l_returnflag <> 'R'), b as (select {_BOUNDS} from r) "
    f"select l_orderkey, l_linenumber, l_extendedprice from r, b where {_INSIDE}",
)
def quantile_trim_rules(spark, sf):
    df = apply_rules(table(spark, sf, "lineitem"), ["l_quantity > 2", "l_returnflag <> 'R'"])
    return trim_quantiles(df, _LINE_COLS).select("l_orderkey", "l_linenumber", "l_extendedprice")


_STEPS = {
    "quantity": "l_quantity between 2 and 48",
    "price": "l_extendedprice < 9e4",
    "discount": "l_discount < 9e-2",
}


@query(
    "rule_funnel",
    """with c as (select count(*) as n0, count(*) filter (l_quantity between 2 and 48) as n1,
  count(*) filter (l_quantity between 2 and 48 and l_extendedprice < 9e4) as n2,
  count(*) filter (l_quantity between 2 and 48 and l_extendedprice < 9e4 and l_discount < 9e-2) as n3 from lineitem)
select 1 as step_no, 'quantity' as step, n0 as rows_before, n1 as rows_after, n0 - n1 as rows_removed from c
union all select 2, 'price', n1, n2, n1 - n2 from c union all select 3, 'discount', n2, n3, n2 - n3 from c""",
)
def rule_funnel(spark, sf):
    return funnel(table(spark, sf, "lineitem"), _STEPS)


@query("drop_incomplete", f"select event_id, Fo from ({SENSOR_SQL}) where Fo is not null and Fb is not null")
def drop_incomplete(spark, sf):
    return nan_to_null(plant_sensors(spark, sf)).na.drop(subset=["Fo", "Fb"]).select("event_id", "Fo")


_SPREAD = {"clicks": "click", "views": "view", "errors": "error"}
_SPREAD_SQL = "wide as (select user_id, cast(date_trunc('day', ts) as timestamp) as day, " + ", ".join(
    f"avg(value) filter (event_type = '{t}') as {c}" for c, t in _SPREAD.items()
) + " from events group by 1, 2)"


def _wide(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("user_id", trunc("ts", "day").alias("day"))
        .agg(*[F.avg(F.when(F.col("event_type") == t, F.col("value"))).alias(c) for c, t in _SPREAD.items()])
    )


@query(
    "require_any",
    f"with {_SPREAD_SQL} select user_id, day, {round_all_sql(list(_SPREAD))} from wide "
    "where coalesce(clicks, views, errors) is not null",
)
def keep_any(spark, sf):
    return round_all(require_any(_wide(spark, sf), list(_SPREAD)), list(_SPREAD))


@query(
    "fill_missing",
    f"with {_SPREAD_SQL} select user_id, day, {', '.join(rounded_sql(f'coalesce({c}, 0)') + f' as {c}' for c in _SPREAD)} from wide",
)
def fill_zero(spark, sf):
    return round_all(fill_missing(_wide(spark, sf), list(_SPREAD)), list(_SPREAD))


@query(
    "align_columns",
    f"with {_SPREAD_SQL} select user_id, day, {rounded_sql('clicks')} as clicks, 0e0 as signups from wide",
)
def align(spark, sf):
    df = align_columns(_wide(spark, sf), ["clicks", "signups"], 0.0, keep=["user_id", "day"])
    return round_all(df, ["clicks"])


_IMPUTED = CONTRACT.sensors


@query(
    "pool_means",
    f"with {_FLAGGED} select {', '.join(rounded_sql(f'avg({c})') + f' as {c}' for c in _IMPUTED)} from flagged where {TRUSTED}",
)
def trusted_means(spark, sf):
    df = flag_invalid(plant_sensors(spark, sf), VALIDITY)
    return round_all(pool_means(df, TRUSTED, _IMPUTED), _IMPUTED)


@query(
    "impute_from_pool",
    f"""with {_FLAGGED}, pool as (select {', '.join(f'avg({c}) as m_{c}' for c in _IMPUTED)} from flagged where {TRUSTED})
select event_id, {', '.join(rounded_sql(f'case when is_outlier = 1 and ({c} is null or {c} <= 0) then m_{c} else {c} end') + f' as {c}' for c in _IMPUTED)}
from flagged, pool""",
)
def impute_from_pool(spark, sf):
    df = flag_invalid(plant_sensors(spark, sf), VALIDITY)
    fixed = impute(df, _IMPUTED, "is_outlier", pool_means(df, TRUSTED, _IMPUTED))
    return round_all(fixed.select("event_id", *_IMPUTED), _IMPUTED)


@query(
    "feature_columns",
    "select o_custkey, o_totalprice, o_orderpriority from orders",
)
def split_features(spark, sf):
    df = table(spark, sf, "orders")
    return df.select(*feature_columns(df, [*NOT_FEATURES, "o_orderkey", "o_orderdate", "o_orderstatus"]))


@query("critical_count", "select count(*) filter (value / 200e0 > 1) as critical from events")
def critical_count(spark, sf):
    return count_where(table(spark, sf, "events"), critical="value / 200e0 > 1")


_NAIVE = "2e-1 + value / 200e0"
_ALERT_SQL = f"""with p as (select event_id, cast(case event_id % 4 when 0 then 2 when 1 then 4 when 2 then 6 else 8 end as integer)
    as horizon_hours, floor((15e-2 + value / 250e0) * 1e4 + 0.5003e0) / 1e4 as prediction, {_NAIVE} as current from events),
d as (select *, floor((prediction - current) * 1e4 + 0.5003e0) / 1e4 as delta from p)
select event_id, horizon_hours, prediction, delta,
  case when prediction > 7e-1 or prediction < 2e-1 then 'RED' when abs(delta) > 1e-1 then 'YELLOW' else 'GREEN' end as alert,
  case when prediction > 7e-1 or prediction < 2e-1
      then 'KRİTİK: ' || horizon_hours || 'h sonrası Si tahmini (' || prediction || ') sınırlar dışında.'
    when abs(delta) > 1e-1 then 'UYARI: ' || horizon_hours || 'h içinde ' || format('{{:+.4f}}', delta) || ' sapma bekleniyor.'
    else horizon_hours || 'h ufku için çalışma rejimi stabil.' end as alert_msg from d"""


@query("alert_levels", _ALERT_SQL)
def alert_levels(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.expr("case event_id % 4 when 0 then 2 when 1 then 4 when 2 then 6 else 8 end").alias("horizon_hours"),
        # off the half, as elsewhere, so that both engines round alike
        F.expr("15e-2 + value / 250e0 + 3e-8").alias("p"),
        F.expr(f"{_NAIVE} - 3e-8").alias("current"),
    )
    return classify_alert(df, "p", "current").drop("p", "current")


@query(
    "sample_rows",
    "select event_id, user_id, value from events order by md5('42:' || event_id), event_id limit 2000",
)
def sample_rows(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "value")
    return sample_n(df, 2000, ["event_id"], seed=42)


@query(
    "input_defaults",
    f"select event_id, coalesce(Fo, 21e0) as Fo, Tc, 450e0 as Tp11 from ({SENSOR_SQL})",
)
def input_defaults(spark, sf):
    df = with_defaults(plant_sensors(spark, sf), {**DEFAULTS, "Tp11": 450.0})
    return df.select("event_id", "Fo", "Tc", "Tp11")


@query(
    "horizon_domain",
    """select event_id % 9 in (2, 4, 6, 8) as accepted, count(*) as n from events group by 1""",
)
def horizon_domain(spark, sf):
    df = table(spark, sf, "events").select(F.expr("event_id % 9").alias("horizon_hours"))
    good, bad = check_domain(df, "horizon_hours", [2, 4, 6, 8])
    both = good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.groupBy("accepted").agg(F.count(F.lit(1)).alias("n"))


@query(
    "calendar_parts",
    """select event_id, cast(hour(ts) as integer) as hour, cast(dayofweek(ts) + 1 as integer) as day_of_week,
  cast(day(ts) as integer) as day_of_month, cast(month(ts) as integer) as month from events""",
)
def calendar_parts(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", *[e.alias(n) for n, e in time_parts("ts").items()])


@query(
    "cyclic_time",
    f"""select event_id, {rounded_sql("sin(2e0 * pi() * hour(ts) / 24e0)")} as hour_sin,
  {rounded_sql("cos(2e0 * pi() * hour(ts) / 24e0)")} as hour_cos,
  {rounded_sql("sin(2e0 * 3.14159e0 * (dayofweek(ts) + 1) / 7e0)")} as dow_sin,
  {rounded_sql("cos(2e0 * 3.14159e0 * (dayofweek(ts) + 1) / 7e0)")} as dow_cos from events""",
)
def cyclic_time(spark, sf):
    parts = time_parts("ts")
    hs, hc = cyclic(parts["hour"], 24)
    ds, dc = cyclic(parts["day_of_week"], 7, pi=3.14159)
    cols = {"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc}
    df = table(spark, sf, "events").select("event_id", *[e.alias(n) for n, e in cols.items()])
    return round_all(df, list(cols))


@query(
    "time_truncation",
    "select event_id, cast(date_trunc('hour', ts) as timestamp) as hour, epoch_us(ts) // 1000000 as epoch_s, "
    "(epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 60e6 as minutes from events",
)
def time_truncation(spark, sf):
    df = table(spark, sf, "events").withColumn("hour", trunc("ts", "hour"))
    return df.select(
        "event_id", "hour", epoch_s("ts").alias("epoch_s"), minutes_between("hour", "ts").alias("minutes")
    )


@query(
    "row_aggregates",
    f"""select event_id, {rounded_sql('(' + ' + '.join(TP) + ') / 10e0')} as mean_tp,
  greatest({', '.join(TP)}) as max_tp, least({', '.join(TP)}) as min_tp,
  greatest({', '.join(TP)}) - least({', '.join(TP)}) as spread_tp,
  {rounded_sql('(Fo + dP) / 2e0')} as strict_mean, {rounded_sql('case when Fo is null then dP else (Fo + dP) / 2e0 end')} as loose_mean
from ({SENSOR_SQL})""",
)
def row_aggregates(spark, sf):
    df = plant_sensors(spark, sf)
    tp = group_cols(df, "Tp")
    out = df.select(
        "event_id",
        row_mean(tp).alias("mean_tp"),
        row_max(tp).alias("max_tp"),
        row_min(tp).alias("min_tp"),
        row_spread(tp).alias("spread_tp"),
        row_mean(["Fo", "dP"]).alias("strict_mean"),
        row_mean(["Fo", "dP"], skip_nulls=True).alias("loose_mean"),
    )
    return round_all(out, ["mean_tp", "strict_mean", "loose_mean"])


@query(
    "ratios_and_products",
    f"""select event_id, {rounded_sql('Fb / nullif(dP + 1e-5, 0)', 4)} as permeability_index,
  {rounded_sql('Th - Tc')} as blast_heat_addition, {rounded_sql('CO2 * H2')} as co2_h2_product,
  {rounded_sql('CO2 / nullif(H2 - 3e0, 0)')} as guarded_ratio from ({SENSOR_SQL})""",
)
def ratios_and_products(spark, sf):
    df = plant_sensors(spark, sf).select(
        "event_id",
        safe_ratio("Fb", "dP").alias("permeability_index"),
        diff_of("Th", "Tc").alias("blast_heat_addition"),
        product("CO2", "H2").alias("co2_h2_product"),
        safe_ratio("CO2", F.col("H2") - F.lit(3.0), eps=0.0).alias("guarded_ratio"),
    )
    cols = {"permeability_index": 4, "blast_heat_addition": 6, "co2_h2_product": 6, "guarded_ratio": 6}
    return round_all(df, cols)


@query("signed_text", "select event_id, format('{:+.2f}', floor(value - 50e0)) as change from events")
def signed_text(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", signed_fmt(F.floor(F.expr("value - 50e0")).cast("double"), 2).alias("change"))
