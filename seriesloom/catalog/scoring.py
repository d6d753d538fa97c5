"""Model training, validation, scoring, attribution and anomaly flags on the derived feature store.

Every query uses all features, all four horizons and all rows. Fitted numbers have no SQL equivalent, so what a
query returns is what SQL can state about them: the rows that go in and come out, and whether the numbers keep
the rules that the operators promise.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.forecast import (
    best_params,
    expanding_cv,
    feature_importance,
    holdout,
    load_models,
    permutation_importance,
    retrain_if_drift,
    save_models,
    scenario_frame,
    score,
    score_scenarios,
    train_horizons,
)
from ..models.attribution import attribution_summary, tree_attribution
from ..models.forest import isolation_forest
from ..operators.quality import feature_columns
from ..operators.resample import resample
from ..operators.stats import drift, forecast_metrics, health
from ..plans.features import build_features
from ..plans.furnace import (
    ANOMALY_INPUTS,
    DEFAULTS,
    FEATURES,
    FURNACE,
    HORIZONS,
    NOT_FEATURES,
    SCENARIO_SENSORS,
    SCENARIOS,
)
from ..plans.silver import build_silver
from ..sources.staging import stage_folder, staged
from .base import plant_sensors, plant_targets, query, table
from .composites import gold_sql

TARGET = "target_Si_{h}h"
GRID = [{}, {"maxIter": 10, "maxDepth": 3}]  # the defaults, and fewer and flatter trees
FOLDS = 3
ALERT_HI, ALERT_LO, ALERT_DEV = 0.70, 0.20, 0.10
GOLD = f"with {gold_sql(False)}, timed_gold as (select *, cast(epoch_us(si_dt) as double) as us from gold)"


def _gold(spark, sf):
    silver = build_silver(plant_sensors(spark, sf), plant_targets(spark, sf), FURNACE)
    return staged(build_features(staged(silver), FEATURES, deduplicate=False))


def _features(gold) -> list[str]:
    return feature_columns(gold, NOT_FEATURES)


def _models(gold):
    return train_horizons(gold, _features(gold), HORIZONS, TARGET)


def _per_horizon(sql: str) -> str:
    return " union all ".join(sql.replace("{h}", str(h)) for h in HORIZONS)


def _sound(df: DataFrame) -> DataFrame:
    """Whether the errors are those of a forecast: positive, and not larger on average than in square."""
    return df.withColumn("sound", (F.col("mae") > 0) & (F.col("rmse") >= F.col("mae")) & (F.col("r2") <= 1))


@query(
    "train_and_evaluate",
    f"""{GOLD}, cut as (select floor(quantile_cont(us, 0.8)) as c from timed_gold) select * from ("""
    + _per_horizon(
        """select cast({h} as integer) as horizon_hours,
  count(*) filter (us <= c and target_Si_{h}h is not null) as n_train,
  count(*) filter (us > c and target_Si_{h}h is not null) as n, true as sound from timed_gold, cut"""
    )
    + ")",
)
def train_and_evaluate(spark, sf):
    gold = _gold(spark, sf)
    train, test = holdout(gold, "si_dt", 0.2)
    known = train.agg(*[F.count(TARGET.format(h=h)).alias(str(h)) for h in HORIZONS]).first()
    parts = []
    for h, m in train_horizons(train, _features(gold), HORIZONS, TARGET).items():
        found = m.predict(test).withColumn("naive", F.col("Si"))
        row = _sound(forecast_metrics(found, "pred", TARGET.format(h=h), "naive"))
        parts.append(row.select(F.lit(h).alias("horizon_hours"), F.lit(known[str(h)]).cast("long").alias("n_train"), "n", "sound"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "expanding_validation",
    GOLD
    + "".join(
        f", cuts{h} as (select "
        + ", ".join(f"floor(quantile_cont(us, {k / (FOLDS + 1)})) as c{k}" for k in range(1, FOLDS + 1))
        + f", max(us) as c{FOLDS + 1} from timed_gold where target_Si_{h}h is not null)"
        for h in HORIZONS
    )
    + " select * from ("
    + " union all ".join(
        f"select cast({h} as integer) as horizon_hours, cast({p} as integer) as params_id, cast({k} as integer) as fold, "
        f"count(*) filter (us > c{k} and us <= c{k + 1}) as n, true as sound, cast(1 as bigint) as n_best "
        f"from timed_gold, cuts{h} where target_Si_{h}h is not null"
        for h in HORIZONS
        for p in range(len(GRID))
        for k in range(1, FOLDS + 1)
    )
    + ")",
)
def expanding_validation(spark, sf):
    gold = _gold(spark, sf)
    parts = []
    for h in HORIZONS:
        cv = staged(expanding_cv(gold, "si_dt", _features(gold), TARGET.format(h=h), GRID, FOLDS))
        n_best = sum(g is best_params(cv, GRID) for g in GRID)
        parts.append(
            _sound(cv).select(F.lit(h).alias("horizon_hours"), "params_id", "fold", "n", "sound", F.lit(n_best).cast("long").alias("n_best"))
        )
    return reduce(DataFrame.unionByName, parts)


def _checked(scored: DataFrame, current: str = "Si") -> DataFrame:
    """Whether delta and alert follow from the prediction."""
    p, d = F.col("prediction"), F.col("delta")
    level = F.when((p > ALERT_HI) | (p < ALERT_LO), "RED").when(F.abs(d) > ALERT_DEV, "YELLOW").otherwise("GREEN")
    return scored.withColumns(
        {"delta_follows": F.abs(d - (p - F.col(current))) < 1e-4, "alert_follows": F.col("alert") == level}
    )


_SCORED = f"""{GOLD} select si_dt, cast(h as integer) as horizon_hours, true as delta_follows, true as alert_follows,
  'success' as status from gold, (select unnest([{", ".join(map(str, HORIZONS))}]) as h)"""


@query("score_horizons", _SCORED)
def score_horizons(spark, sf):
    gold = _gold(spark, sf)
    scored = _checked(score(gold, _models(gold), keep=["si_dt"]))
    return scored.select("si_dt", "horizon_hours", "delta_follows", "alert_follows", "status")


@query("save_and_load_models", _SCORED.replace("true as alert_follows", "true as same_prediction"))
def saved_models(spark, sf):
    gold = _gold(spark, sf)
    models = _models(gold)
    path = f"{stage_folder(spark)}/models-{uuid.uuid4().hex}"
    save_models(models, spark, path)
    direct = score(gold, models, keep=["si_dt"]).select("si_dt", "horizon_hours", F.col("prediction").alias("direct"))
    loaded = _checked(score(gold, load_models(spark, path), keep=["si_dt"])).join(direct, ["si_dt", "horizon_hours"])
    same = F.col("prediction").eqNullSafe(F.col("direct")).alias("same_prediction")
    return loaded.select("si_dt", "horizon_hours", "delta_follows", same, "status")


@query(
    "score_scenarios",
    "select * from ("
    + " union all ".join(
        f"select '{name}' as scenario, '{text}' as description, cast({h} as integer) as horizon_hours, "
        "true as delta_follows, true as alert_follows, true as range_follows"
        for name, text, *_ in SCENARIOS
        for h in HORIZONS
    )
    + ") where (select count(*) from events) > 0",
)
def scenarios(spark, sf):
    scored = score_scenarios(scenario_frame(spark, SCENARIOS, SCENARIO_SENSORS, DEFAULTS), _models(_gold(spark, sf)))
    lo, hi = F.col("expected_si_range")[0], F.col("expected_si_range")[1]
    inside = (F.col("prediction") >= lo) & (F.col("prediction") <= hi)
    return _checked(scored).select(
        "scenario", "description", "horizon_hours", "delta_follows", "alert_follows",
        (F.col("in_expected_range") == inside).alias("range_follows"),
    )


_N_FEATURES = len(FEATURES.order) - len([c for c in NOT_FEATURES if c in FEATURES.order])


@query(
    "feature_importance",
    _per_horizon(
        f"select cast({{h}} as integer) as horizon_hours, cast({_N_FEATURES} as bigint) as n_features, true as sums_to_one "
        "where (select count(*) from events) > 0"
    ),
)
def importance(spark, sf):
    parts = [
        feature_importance(m, spark).agg(
            F.lit(h).alias("horizon_hours"), F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one")
        )
        for h, m in _models(_gold(spark, sf)).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "permutation_importance",
    _per_horizon(
        f"select cast({{h}} as integer) as horizon_hours, cast({_N_FEATURES} as bigint) as n_features, true as sound "
        "where (select count(*) from events) > 0"
    ),
)
def attribution(spark, sf):
    gold = _gold(spark, sf)
    parts = []
    for h, m in _models(gold).items():
        found = permutation_importance(gold, m, TARGET.format(h=h), ["si_dt"])
        # an effect has at least the size of its mean, and of what it does to the error
        at_least = F.greatest(F.abs("mean_effect"), F.abs("mae_increase")) <= F.col("mean_abs_effect") + 1e-12
        parts.append(found.agg(F.lit(h).alias("horizon_hours"), F.count(F.lit(1)).alias("n_features"), F.min(at_least).alias("sound")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "tree_attribution",
    f"{GOLD} "
    + _per_horizon(
        f"""select cast({{h}} as integer) as horizon_hours, cast({_N_FEATURES} as bigint) as n_features,
  count(*) as n_rows, count(*) as n_additive, true as sound from gold where target_Si_{{h}}h is not null"""
    ),
)
def shapley_values(spark, sf):
    gold = _gold(spark, sf)
    parts = []
    for h, m in _models(gold).items():
        known = gold.where(F.col(TARGET.format(h=h)).isNotNull())
        summary = attribution_summary(gold, m, TARGET.format(h=h))
        at_least = F.abs("mean_effect") <= F.col("mean_abs_effect") + 1e-12
        checked = summary.agg(
            F.lit(h).alias("horizon_hours"),
            F.count(F.lit(1)).alias("n_features"),
            F.max("n").alias("n_rows"),
            (F.min(at_least) & (F.max("mean_abs_effect") > 0)).alias("sound"),
        )
        rows = tree_attribution(m.predict(known), m, ["pred"])
        explained = F.col("base") + F.aggregate("effects", F.lit(0.0), lambda a, b: a + b)
        n_additive = F.count_if(F.abs(explained - F.col("pred")) < 1e-9)
        checked = checked.withColumn("n_additive", rows.agg(n_additive).scalar())
        parts.append(checked.select("horizon_hours", "n_features", "n_rows", "n_additive", "sound"))
    return reduce(DataFrame.unionByName, parts)


LIMITS = (0.01, 10.0)


@query(
    "retrain_on_drift",
    GOLD
    + """, watched as (select si_dt, avg(abs(Si - target_Si_2h)) over (order by epoch_us(si_dt) // 1000000
  range between 604800 preceding and current row) as mae from gold where target_Si_2h is not null)"""
    + " select * from ("
    + " union all ".join(
        f"select {x}e0 as abs_limit, arg_max(mae, si_dt) > {x}e0 as renewed, "
        f"case when arg_max(mae, si_dt) > {x}e0 then cast({len(HORIZONS)} as bigint) else cast(0 as bigint) end as n_models from watched"
        for x in LIMITS
    )
    + ")",
)
def retrain(spark, sf):
    gold = _gold(spark, sf)
    known = gold.where(F.col(TARGET.format(h=2)).isNotNull())
    rows = []
    for limit in LIMITS:
        watched = drift(known, "si_dt", "Si", TARGET.format(h=2), 1e6, abs_limit=limit)
        models, renewed = retrain_if_drift(watched, {}, lambda: _models(gold), "si_dt")
        rows.append((limit, renewed, len(models)))
    return spark.createDataFrame(rows, "abs_limit double, renewed boolean, n_models long")


# the cut lies between two scores, so at most this many are above it
_MOST = "count(*) - 1 - cast(floor((count(*) - 1) * 0.95e0) as bigint)"


@query("anomaly_flags", f"{GOLD} select count(*) as n, {_MOST} as most, true as within from gold")
def anomaly_flags(spark, sf):
    flags = isolation_forest(_gold(spark, sf), ANOMALY_INPUTS, ["si_dt"])
    bad, scores = F.count_if(F.col("is_anomalous") == -1), F.col("anomaly_score")
    most = F.count(F.lit(1)) - 1 - F.floor((F.count(F.lit(1)) - 1) * F.lit(0.95))
    fair = (bad > 0) & (bad <= most) & (F.min(scores) > 0) & (F.max(scores) <= 1)
    return flags.agg(F.count(F.lit(1)).alias("n"), most.alias("most"), fair.alias("within"))


@query(
    "anomaly_health",
    f"""with h as (select user_id, date_trunc('hour', ts) as ts from events group by all)
select count(*) as total, {_MOST} as most, true as within from h""",
)
def anomaly_health(spark, sf):
    df = resample(table(spark, sf, "events"), "ts", "hour", {"value": "avg", "event_id": "count"}, ["user_id"])
    found = health(isolation_forest(staged(df), ["value", "event_id"], ["user_id", "ts"]), "is_anomalous")
    most = F.col("total") - 1 - F.floor((F.col("total") - 1) * F.lit(0.95))
    rate = F.abs(F.col("anomaly_rate") * 100 + F.col("health_pct") - 100) < 1e-9
    return found.select("total", most.alias("most"), ((F.col("anomalies") <= most) & rate).alias("within"))
