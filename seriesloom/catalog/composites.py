"""Silver, feature store and cleaning cascade on plant data derived from events."""

from __future__ import annotations

from ..functions import parse_ts
from ..plans.cleaning import clean_cascade, cleaning_funnel, match_targets
from ..plans.features import build_features
from ..plans.furnace import CLEANING, CONTRACT, FEATURES, FURNACE, PI, TP, TRACKED, TT, VALIDITY
from ..plans.silver import build_silver
from ..plans.spec import CleaningStep
from ..sources.staging import staged
from .base import (
    SENSOR_SQL,
    TARGET_SQL,
    plant_sensors,
    plant_targets,
    query,
    round_all,
    round_all_sql,
    rounded_sql,
)

COLS = CONTRACT.sensors
BIG = {"Fo": 4, "Fb": 5}


def _silver_sql(keyed: bool, drop_outliers: bool = False) -> str:
    """CTEs ending in ``silver``."""
    k, on = ("line, ", "line, ") if keyed else ("", "")
    valid = " and ".join(f"({r})" for r in VALIDITY)
    fixed = ", ".join(
        f"case when is_outlier = 1 and ({c} is null or {c} <= 0) and m_{c} is not null then m_{c} else {c} end as {c}"
        for c in COLS
    )
    order = ", ".join(f"{c} desc nulls last" for c in ("source_type", *COLS))
    return f"""
sensors as ({SENSOR_SQL}),
targets as ({TARGET_SQL}),
flagged as (select *, case when coalesce({valid}, false) then 0 else 1 end as is_outlier from sensors),
pool as (select {", ".join(f"avg({c}) as m_{c}" for c in COLS)} from flagged
  where source_type = 'second' or (source_type = 'first' and is_outlier = 0)),
readings as (select *, cast(dt as timestamp) as t from flagged {"where is_outlier = 0" if drop_outliers else ""}
  qualify row_number() over (partition by {k}dt order by {order}) = 1),
fixed as (select {k}t, {fixed} from readings, pool),
hourly as (select {k}date_trunc('hour', t) as si_dt, {", ".join(f"avg({c}) as {c}" for c in COLS)}
  from fixed group by all),
latest as (select {k}date_trunc('hour', cast(dt as timestamp)) as si_dt, Si from targets
  qualify row_number() over (partition by {k}date_trunc('hour', cast(dt as timestamp))
    order by cast(dt as timestamp) desc, Si desc) = 1),
silver as (select {k}cast(si_dt as timestamp) as si_dt, Si, {", ".join(COLS)}
  from hourly join latest using ({on}si_dt)
  where {" and ".join(f"{c} is not null" for c in ("Si", *COLS))})"""


def _silver(spark, sf, keyed=False, drop_outliers=False):
    keys = ["line"] if keyed else []
    return build_silver(
        plant_sensors(spark, sf, keyed), plant_targets(spark, sf, keyed), FURNACE, keys, drop_outliers
    )


_SHOWN = {**dict.fromkeys(("Si", *COLS), 6), **BIG}


@query("silver_build", f"with {_silver_sql(False)} select si_dt, {round_all_sql(_SHOWN)} from silver")
def silver_build(spark, sf):
    return round_all(_silver(spark, sf), _SHOWN)


@query(
    "silver_build_keyed", f"with {_silver_sql(True)} select line, si_dt, {round_all_sql(_SHOWN)} from silver"
)
def silver_build_keyed(spark, sf):
    return round_all(_silver(spark, sf, keyed=True), _SHOWN)


@query(
    "silver_build_without_outliers",
    f"with {_silver_sql(False, True)} select si_dt, {round_all_sql(_SHOWN)} from silver",
)
def silver_build_without_outliers(spark, sf):
    return round_all(_silver(spark, sf, drop_outliers=True), _SHOWN)


def gold_sql(keyed: bool) -> str:
    """CTEs ending in ``gold``."""
    p = "partition by line " if keyed else ""
    k = "line, " if keyed else ""
    eps = "1e-5"

    def over(hours: float) -> str:
        return f"({p}order by s range between {int(hours * 3600)} preceding and current row)"

    def mean(cols: list[str]) -> str:
        return f"({' + '.join(cols)}) / {len(cols)}e0"

    def ratio(a: str, b: str) -> str:
        return f"{a} / nullif({b} + {eps}, 0)"

    row = {
        "mean_tp": mean(TP),
        "mean_tt": mean(TT),
        "tp_imbalance": f"greatest({', '.join(TP)}) - least({', '.join(TP)})",
        "furnace_thermal_drop": f"Th - {mean(TT)}",
        "blast_heat_addition": "Th - Tc",
        "thermal_position_index": ratio(f"({mean(TP)})", mean(TT)),
        "permeability_index": ratio("Fb", "dP"),
        "pressure_distribution_ratio": ratio("dPu", "dPl"),
        "specific_co2_generation": ratio("CO2", "Fb"),
        "gas_reduction_ratio": ratio("CO2", "H2"),
        "blast_heat_index": "Fb * Th",
        "oxygen_enrichment_ratio": ratio("Fo", "Fb"),
        "permeability_k_index": ratio("Fb", "dP"),
        "specific_pressure_drop": ratio("dP", "Fb"),
        "thermal_burden_balance": ratio("(Fb * Th)", "R"),
        "gas_utilization_proxy": ratio("CO2", "Fb"),
        "fb_th_ratio": ratio("Fb", "Th"),
        "co2_h2_product": "CO2 * H2",
        "dp_r_product": "dP * R",
        "hour": "cast(hour(si_dt) as integer)",
        "day_of_week": "cast(dayofweek(si_dt) + 1 as integer)",
        "day_of_month": "cast(day(si_dt) as integer)",
        "month": "cast(month(si_dt) as integer)",
    }
    win = {f"Si_lag_{n}h": f"lag(Si, {n}) over w" for n in (1, 2, 3, 4, 8, 12)}
    win |= {f"Si_roll_mean_{h}h": f"avg(Si) over {over(h)}" for h in (4, 8, 24)}
    win["Si_roll_std_4h"] = f"stddev_samp(Si) over {over(4)}"
    for c in TRACKED:
        win |= {f"{c}_lag_1h": f"lag({c}, 1) over w", f"{c}_lag_4h": f"lag({c}, 4) over w"}
        win[f"{c}_roll_mean_4h"] = f"avg({c}) over {over(4)}"
    win |= {
        "tp_stability_4h": f"avg(tp_imbalance) over {over(4)}",
        "thermal_drop_trend_4h": f"avg(furnace_thermal_drop) over {over(4)}",
        "dP_roll_std_4h": f"stddev_samp(dP) over {over(4)}",
        "co2_volatility_1h": f"stddev_samp(CO2) over {over(1)}",
        "co2_volatility_4h": f"stddev_samp(CO2) over {over(4)}",
        "co2_gen_trend_4h": f"avg(specific_co2_generation) over {over(4)}",
        "delta_t_hours": "(s - lag(s) over w) / 3600e0",
        "next_si_dt": "lead(si_dt) over w",
        "hours_to_next_cast": "(lead(s) over w - s) / 3600e0",
    }
    for c in ["Si", *TRACKED]:
        win[f"{c}_diff_1h"] = f"{c} - lag({c}) over w"
        win[f"{c}_diff_pct"] = f"({c} - lag({c}) over w) / nullif(lag({c}) over w + {eps}, 0)"
    for q, c in [("si", "Si"), ("th", "Th"), ("fb", "Fb"), ("co2", "CO2")]:
        win[f"{q}_velocity"] = f"({c} - lag({c}) over w) / nullif((s - lag(s) over w) / 3600e0 + {eps}, 0)"
    for h in (2, 4, 6, 8):
        frame = f"{p}order by s range between {int((h - 1.5) * 3600)} following and {int((h + 1.5) * 3600)} following"
        win[f"target_Si_{h}h"] = f"last_value(Si ignore nulls) over ({frame})"
    acc = {
        f"{q}_acceleration": f"({q}_velocity - lag({q}_velocity) over w) / nullif(delta_t_hours + {eps}, 0)"
        for q in ("si", "th")
    }
    cyc = {
        "hour_sin": f"sin(2e0 * {PI}e0 * hour / 24e0)",
        "hour_cos": f"cos(2e0 * {PI}e0 * hour / 24e0)",
        "dow_sin": f"sin(2e0 * {PI}e0 * day_of_week / 7e0)",
        "dow_cos": f"cos(2e0 * {PI}e0 * day_of_week / 7e0)",
    }

    def items(d: dict[str, str]) -> str:
        return ", ".join(f"{e} as {n}" for n, e in d.items())

    ordered = f"window w as ({p}order by s)"
    return f"""{_silver_sql(keyed)},
timed as (select *, epoch_us(si_dt) // 1000000 as s from silver),
kept as (select * from timed
  qualify coalesce((s - lag(s) over ({p}order by s)) / 3600e0 < 6, true)),
rowwise as (select *, {items(row)} from kept),
windowed as (select *, {items(win)} from rowwise {ordered}),
accelerated as (select *, {items(acc)}, {items(cyc)} from windowed {ordered}),
gold as (select {k}{", ".join(FEATURES.order)} from accelerated
  where coalesce({", ".join(f"target_Si_{h}h" for h in (2, 4, 6, 8))}) is not null
    and si_velocity is not null and th_acceleration is not null and permeability_index is not null)"""


_WHOLE = {"si_dt", "next_si_dt", "hour", "day_of_week", "day_of_month", "month"}
_GOLD = {c: 6 for c in FEATURES.order if c not in _WHOLE}
_GOLD |= {c: 4 for c in _GOLD if c.startswith(("Fb", "Fo", "fb_", "Th", "th_", "permeability"))}
_GOLD |= {"blast_heat_index": 1, "thermal_burden_balance": 1}


def _gold_select(keyed: bool) -> str:
    k = "line, " if keyed else ""
    shown = ", ".join(
        c if c in _WHOLE else f"{rounded_sql(c, _GOLD[c])} as {c}" for c in FEATURES.order
    )
    return f"with {gold_sql(keyed)} select {k}{shown} from gold"


@query("feature_store", _gold_select(False))
def feature_store(spark, sf):
    return round_all(build_features(staged(_silver(spark, sf)), FEATURES, deduplicate=False), _GOLD)


@query("feature_store_keyed", _gold_select(True))
def feature_store_keyed(spark, sf):
    silver = staged(_silver(spark, sf, keyed=True))
    return round_all(build_features(silver, FEATURES, keys=["line"], deduplicate=False), _GOLD)


def _matched(spark, sf):
    sensors = plant_sensors(spark, sf).drop("source_type", "event_id")
    targets = plant_targets(spark, sf).drop("source_type")
    sensors = sensors.withColumn("dt", parse_ts("dt")).groupBy("dt").mean(*COLS)
    sensors = sensors.toDF("dt", *COLS)
    return match_targets(targets.withColumn("dt", parse_ts("dt")), sensors)


def _cascade_sql(steps: tuple[CleaningStep, ...]) -> str:
    """CTEs ``s0`` (matched rows) to ``s{n}`` (rows after the n-th step)."""
    out = [
        f"""sensors as (select cast(dt as timestamp) as sensor_dt, {", ".join(f"avg({c}) as {c}" for c in COLS)}
  from ({SENSOR_SQL}) group by all),
targets as (select cast(dt as timestamp) as dt, Si, event_id from ({TARGET_SQL})),
s0 as (select targets.*, sensors.* from targets asof left join sensors on targets.dt >= sensors.sensor_dt)"""
    ]
    for i, step in enumerate(steps):
        rules = " and ".join(f"({r})" for r in step.rules)
        if not step.trim:
            out.append(f"s{i + 1} as (select * from s{i} where {rules})")
            continue
        qs = ", ".join(
            f"quantile_cont({c}, {step.lo}) as lo_{c}, quantile_cont({c}, {step.hi}) as hi_{c}" for c in step.trim
        )
        inside = " and ".join(f"{c} between lo_{c} and hi_{c}" for c in step.trim)
        base = f"where {rules}" if step.bounds_after_rules else ""
        out.append(f"b{i} as (select {qs} from s{i} {base})")
        out.append(f"s{i + 1} as (select s{i}.* from s{i}, b{i} where {rules} and {inside})")
    return ",\n".join(out)


@query(
    "cleaning_cascade",
    f"with {_cascade_sql(CLEANING)} select event_id, dt, sensor_dt, {round_all_sql(_SHOWN)} from s{len(CLEANING)}",
)
def cleaning_cascade(spark, sf):
    cleaned = clean_cascade(staged(_matched(spark, sf)), CLEANING)
    return round_all(cleaned.select("event_id", "dt", "sensor_dt", "Si", *COLS), _SHOWN)


@query(
    "cleaning_funnel",
    f"with {_cascade_sql(CLEANING)} "
    + " union all ".join(
        f"select cast({i} as integer) as step_no, '{s.name}' as step, (select count(*) from s{i - 1}) as rows_before, "
        f"(select count(*) from s{i}) as rows_after, "
        f"(select count(*) from s{i - 1}) - (select count(*) from s{i}) as rows_removed"
        for i, s in enumerate(CLEANING, 1)
    ),
)
def cleaning_steps(spark, sf):
    return cleaning_funnel(staged(_matched(spark, sf)), CLEANING)
