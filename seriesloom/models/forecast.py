"""Per-horizon forecasts on Spark ML: training, time-ordered validation, scoring and attribution."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import epoch_us
from ..operators.dedup import sample_n, top_k
from ..sources.staging import staged
from ..operators.quality import with_defaults
from ..operators.quantiles import exact_quantiles
from ..operators.serving import classify_alert
from ..operators.stats import forecast_metrics

PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "maxBins": 64}
_X, _Y = "_features", "_actual"


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """Feature vector in a fixed order; a missing feature counts as 0."""
    kept = df.columns if keep is None else list(keep)
    filled = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in features
    ]
    return df.select(*kept, array_to_vector(F.array(*filled)).alias(_X))


@dataclass(frozen=True)
class HorizonModel:
    horizon: int
    features: tuple[str, ...]
    model: GBTRegressionModel

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return self.on_vector(assemble(df, self.features), out).drop(_X)

    def on_vector(self, df: DataFrame, out: str) -> DataFrame:
        """Predictions for a frame with an assembled vector; the model itself is not changed."""
        return self.model.copy().setFeaturesCol(_X).setPredictionCol(out).transform(df)


def save_models(models: Mapping[int, HorizonModel], spark: SparkSession, path: str) -> None:
    """One Spark ML model a horizon below ``path``, and a table of their horizons and feature orders."""
    rows = [(h, list(m.features)) for h, m in sorted(models.items())]
    for h, m in models.items():
        m.model.write().overwrite().save(f"{path}/horizon={h}")
    spark.createDataFrame(rows, "horizon int, features array<string>").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/features"
    )


def load_models(spark: SparkSession, path: str) -> dict[int, HorizonModel]:
    """The models that ``save_models`` wrote."""
    rows = spark.read.parquet(f"{path}/features").collect()
    return {
        r["horizon"]: HorizonModel(
            r["horizon"], tuple(r["features"]), GBTRegressionModel.load(f"{path}/horizon={r['horizon']}")
        )
        for r in rows
    }


def _learner(seed: int, params: Mapping) -> GBTRegressor:
    return GBTRegressor(featuresCol=_X, labelCol=_Y, seed=seed, **{**PARAMS, **params})


def fit_one(df: DataFrame, features: Sequence[str], target: str, seed: int = 42, **params) -> GBTRegressionModel:
    """One gradient-boosted regressor on the rows whose target is known."""
    known = df.where(F.col(target).isNotNull()).withColumn(_Y, F.col(target).cast("double"))
    return _learner(seed, params).fit(assemble(known, features, [_Y]))


def _side_by_side(fit: Callable[[Any], HorizonModel], of: Iterable[Any], parallelism: int) -> list[HorizonModel]:
    """Fits whose many small jobs wait for the driver leave the cluster idle, so several run at a time."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(fit), of))


def train_horizons(
    df: DataFrame,
    features: Sequence[str],
    horizons: Sequence[int] = (2, 4, 6, 8),
    target: str = "target_Si_{h}h",
    params: Mapping[int, Mapping] | None = None,
    seed: int = 42,
    parallelism: int = 4,
) -> dict[int, HorizonModel]:
    """An independent model per horizon. Pass a stored frame: every model reads it several times."""

    def fit(h: int) -> HorizonModel:
        return HorizonModel(h, tuple(features), fit_one(df, features, target.format(h=h), seed, **(params or {}).get(h, {})))

    return dict(zip(horizons, _side_by_side(fit, horizons, parallelism)))


def time_cuts(df: DataFrame, ts: str, shares: Sequence[float]) -> list[int]:
    """Event times, in microseconds, below which the given shares of the rows lie."""
    timed = df.select(epoch_us(ts).cast("double").alias("_t"))
    return [int(v) for v in exact_quantiles(timed, ["_t"], shares)["_t"]]


def holdout(df: DataFrame, ts: str, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The earlier rows for training and the last ``test_size`` of the rows for the test."""
    (cut,) = time_cuts(df, ts, [1 - test_size])
    at = epoch_us(ts)
    return df.where(at <= cut), df.where(at > cut)


def expanding_cv(
    df: DataFrame,
    ts: str,
    features: Sequence[str],
    target: str,
    grid: Sequence[Mapping],
    n_folds: int = 3,
    seed: int = 42,
    stage: Callable[[DataFrame], DataFrame] = staged,
    parallelism: int = 4,
) -> DataFrame:
    """Error of every parameter set on folds that each train on all earlier rows.

    Fold k trains on the first k of n_folds + 1 equal time slices and is tested on the next one.
    Returns one row per parameter set and fold; ``best_params`` picks from it. The assembled rows are stored
    once through ``stage``; every fold and set filters them by time.
    """
    known = df.where(F.col(target).isNotNull())
    cuts = time_cuts(known, ts, [k / (n_folds + 1) for k in range(1, n_folds + 1)] + [1.0])
    timed = known.select(F.col(target).cast("double").alias(_Y), epoch_us(ts).alias("_at"), *features)
    known = stage(assemble(timed, features, [_Y, "_at"]))
    at, trials = F.col("_at"), [(i, k) for i in range(len(grid)) for k in range(n_folds)]

    def fit(trial: tuple[int, int]) -> HorizonModel:
        i, k = trial
        return HorizonModel(0, tuple(features), _learner(seed, grid[i]).fit(known.where(at <= cuts[k])))

    results = []
    for (i, k), model in zip(trials, _side_by_side(fit, trials, parallelism)):
        test = known.where((at > cuts[k]) & (at <= cuts[k + 1]))
        metrics = forecast_metrics(model.on_vector(test, "pred"), "pred", _Y)
        results.append(metrics.select(F.lit(i).alias("params_id"), F.lit(k + 1).alias("fold"), "n", "mae", "rmse", "r2"))
    return reduce(DataFrame.unionByName, results)


def best_params(cv: DataFrame, grid: Sequence[Mapping]) -> Mapping:
    """The parameter set with the lowest mean error over the folds."""
    means = cv.groupBy("params_id").agg(F.avg("mae").alias("mae"))
    return grid[means.orderBy("mae", "params_id").first()["params_id"]]


def score(
    df: DataFrame,
    models: Mapping[int, HorizonModel],
    current: str = "Si",
    horizons: Sequence[int] | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Prediction, delta against the current value, alert and message per row and horizon, in one pass."""
    kept = list(dict.fromkeys([*(keep if keep is not None else df.columns), current]))
    chosen = [models[h] for h in (horizons or models)]
    wide, names = df, []
    for features in dict.fromkeys(m.features for m in chosen):
        wide = assemble(wide, features)
        for m in chosen:
            if m.features == features:
                names.append((m.horizon, f"_pred_{len(names)}"))
                wide = m.on_vector(wide, names[-1][1])
        wide = wide.drop(_X)
    found = F.array(*[F.struct(F.lit(h).alias("horizon_hours"), F.col(c).alias("pred")) for h, c in names])
    long = wide.select(*kept, F.explode(found).alias("_f")).select(*kept, "_f.horizon_hours", "_f.pred")
    rated = classify_alert(long, "pred", current)
    return rated.withColumn("status", F.lit("success")).drop("pred")


def scenario_frame(
    spark: SparkSession,
    scenarios: Sequence[tuple[str, str, float, float, Sequence[float]]],
    sensors: Sequence[str],
    defaults: Mapping[str, float],
) -> DataFrame:
    """Named operating regimes as rows, with defaults for the inputs they do not give."""
    rows = [(name, text, [lo, hi], dict(zip(sensors, values))) for name, text, lo, hi, values in scenarios]
    df = spark.createDataFrame(
        rows,
        "scenario string, description string, expected_si_range array<double>, sensor_values map<string,double>",
    )
    wide = df.select(
        "scenario", "description", "expected_si_range", *[F.col("sensor_values")[c].alias(c) for c in sensors]
    )
    return with_defaults(wide, defaults)


def score_scenarios(
    scenarios: DataFrame, models: Mapping[int, HorizonModel], current: str = "Si"
) -> DataFrame:
    """Prediction per scenario and horizon, and whether it falls in the expected range."""
    rated = score(scenarios, models, current, keep=["scenario", "description", "expected_si_range", current])
    lo, hi = F.col("expected_si_range")[0], F.col("expected_si_range")[1]
    return rated.withColumn("in_expected_range", F.col("prediction").between(lo, hi))


def feature_importance(model: HorizonModel, spark: SparkSession, k: int | None = None) -> DataFrame:
    """Importance per feature, greatest first."""
    rows = [(c, float(v)) for c, v in zip(model.features, model.model.featureImportances.toArray())]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return top_k(df, "importance", k or len(rows), ["feature"])


def permutation_importance(
    df: DataFrame,
    model: HorizonModel,
    target: str,
    ids: Sequence[str],
    n: int | None = None,
    seed: int = 42,
    group_rows: int = 50_000,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Effect of each feature on the predictions of a model, from all rows with a known target.

    One feature at a time takes the value of another row. ``mae_increase`` is what that adds to the error,
    ``mean_abs_effect`` how far it moves the prediction, ``mean_effect`` the same with a sign (positive if a
    greater value raises the prediction), ``direction`` the correlation of the value with the prediction.

    Rows are dealt into groups of about ``group_rows`` by a seeded hash and take values from the next row of
    their group in hash order, so no task holds all of them. ``n`` limits the rows to a sample by hash. The
    rows are stored through ``stage``, since every feature multiplies them.
    """
    cols = list(model.features)
    known = df.where(F.col(target).isNotNull())
    picked = known if n is None else sample_n(known, n, ids, seed)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    place = F.xxhash64(F.lit(seed), *[F.col(c) for c in ids])
    slim = stage(picked.select(F.col(target).cast("double").alias(_Y), values.alias("own"), place.alias("_at"), *ids))
    groups = max(1, -(-slim.count() // group_rows))
    slim = slim.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups)))
    order = Window.partitionBy("_group").orderBy("_at", *ids)
    first = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = slim.withColumn("other", F.coalesce(F.lead("own").over(order), F.first("own").over(first)))
    plain = model.on_vector(rows.withColumn(_X, array_to_vector("own")), "plain").drop(_X)
    tried = plain.select(
        _Y, "own", "other", "plain", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))).alias("f")
    ).select(
        _Y,
        "f",
        "plain",
        F.get("own", F.col("f")).alias("was"),
        F.get("other", F.col("f")).alias("x"),
        array_to_vector(
            F.transform("own", lambda v, i: F.when(i == F.col("f"), F.get("other", i)).otherwise(v))
        ).alias(_X),
    )
    scored = model.on_vector(tried, "pred")
    moved, error = F.col("plain") - F.col("pred"), F.abs(F.col("pred") - F.col(_Y))
    per = scored.groupBy("f").agg(
        F.avg(error - F.abs(F.col("plain") - F.col(_Y))).alias("mae_increase"),
        F.avg(F.abs(moved)).alias("mean_abs_effect"),
        F.avg(moved * F.signum(F.col("was") - F.col("x"))).alias("mean_effect"),
        F.corr("x", "pred").alias("direction"),
    )
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("f") + 1)
    return per.select(names.alias("feature"), "mae_increase", "mean_abs_effect", "mean_effect", "direction")


def retrain_if_drift(
    monitored: DataFrame,
    models: Mapping[int, HorizonModel],
    train: Callable[[], Mapping[int, HorizonModel]],
    ts: str,
    flag: str = "drift",
) -> tuple[Mapping[int, HorizonModel], bool]:
    """New models when the latest monitored row shows drift, the given ones otherwise."""
    latest = monitored.agg(F.max_by(flag, F.struct(ts, flag)).alias("f")).first()["f"]  # of equal times, drift
    return (train(), True) if latest == 1 else (models, False)
