"""Rules, imputation, quantiles, alerts and sampling on hand-made rows."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.functions import group_cols, nan_to_null, row_mean, row_spread, safe_ratio, signed_fmt
from seriesloom.operators.dedup import dedup, first_per, sample_n
from seriesloom.operators.quality import (
    check_domain,
    flag_invalid,
    funnel,
    impute,
    pool_means,
    require_any,
    require_rows,
    with_defaults,
)
from seriesloom.operators.quantiles import exact_quantiles, quantile_bounds, trim_quantiles
from seriesloom.operators.serving import classify_alert, serve_features
from seriesloom.plans.furnace import CONTRACT, DEFAULTS, NOT_NAN, SCENARIO_SENSORS, SCENARIOS, VALIDITY

NAN = float("nan")


def test_null_and_nan_are_invalid_and_imputed(spark):
    df = spark.createDataFrame(
        [(0, 5.0), (1, None), (2, NAN), (3, 0.0), (4, -1.0), (5, 99.0)], "id int, x double"
    )
    flagged = flag_invalid(df, ["x between 1 and 10"])
    assert [r["is_outlier"] for r in flagged.orderBy("id").collect()] == [0, 1, 1, 1, 1, 1]
    pool = pool_means(flagged, "is_outlier = 0 or id = 5", ["x"])
    for fill in (pool, pool.first().asDict()):
        fixed = impute(flagged, ["x"], "is_outlier", fill)
        assert [r["x"] for r in fixed.orderBy("id").collect()] == [5.0, 52.0, 52.0, 52.0, 52.0, 99.0]


def test_unflagged_values_stay(spark):
    df = spark.createDataFrame([(0, -1.0, 0), (1, NAN, 0), (2, None, 0)], "id int, x double, f int")
    fixed = impute(df, ["x"], "f", {"x": 7.0}).orderBy("id").collect()
    assert [r["x"] for r in fixed] == [-1.0, None, None]


def test_nan_in_an_open_rule_is_invalid(spark):
    good = dict(zip(SCENARIO_SENSORS, SCENARIOS[0][4])) | {"Fo": 21.0, "dPu": 0.5, "dPl": 0.7}
    rows = [good, good | {"Pc": NAN}, good | {"Tp3": NAN}, good | {"Fo": None}, good | {"Ph": NAN}]
    schema = ", ".join(f"{c} double" for c in CONTRACT.sensors)
    df = spark.createDataFrame([tuple(r[c] for c in CONTRACT.sensors) for r in rows], schema)
    flagged = flag_invalid(df, [*VALIDITY, *NOT_NAN])
    assert [r["is_outlier"] for r in flagged.collect()] == [0, 1, 1, 1, 0]


def test_every_scenario_is_valid_with_defaults(spark):
    rows = [tuple(values) for *_, values in SCENARIOS]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in SCENARIO_SENSORS))
    flagged = flag_invalid(with_defaults(df, DEFAULTS), VALIDITY)
    assert {r["is_outlier"] for r in flagged.collect()} == {0}


def test_row_aggregates_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (1.0, 2.0, 3.0)], "T10 double, T2 double, T1 double")
    assert group_cols(df, "T") == ["T1", "T2", "T10"]
    out = df.select(
        row_mean(df.columns).alias("strict"),
        row_mean(df.columns, skip_nulls=True).alias("loose"),
        row_spread(df.columns).alias("spread"),
    ).collect()
    assert [tuple(r) for r in out] == [(None, 2.5, 3.0), (2.0, 2.0, 2.0)]


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, -1e-5), (1.0, 0.0), (NAN, 1.0)], "a double, b double")
    ratios = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert ratios[0] is None and ratios[1] == pytest.approx(1e5) and np.isnan(ratios[2])
    assert nan_to_null(df).where("a is null").count() == 1
    assert df.select(signed_fmt(F.lit(0.5))).first()[0] == "+0.5000"


def test_duplicates_have_a_total_order(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "first", 1), (t, "second", 2), (t, "second", 3), (None, "first", 4)], "t timestamp_ntz, tag string, id int")
    order = [F.col("tag").desc(), "id"]
    assert first_per(df.where("t is not null"), ["t"], order).first()["id"] == 2
    assert [r["id"] for r in dedup(df, ["t"], order).collect()] == [2]


@pytest.mark.parametrize("direct_rows", [10**6, 50, 7])
def test_exact_quantiles(spark, direct_rows):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=900), np.repeat(0.25, 400), [7.0]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    probs = [0.0, 0.01, 0.37, 0.5, 0.6, 0.99, 1.0]
    got = exact_quantiles(df, ["x"], probs, direct_rows)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)


def test_trim_keeps_both_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert trim_quantiles(df, ["x"], 0.01, 0.99).count() == 99
    assert quantile_bounds(df, ["x"], 0.1, 0.9, approx=True)["x"] == (10.0, 90.0)


def test_funnel(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "x int")
    rows = funnel(df, {"low": "x >= 2", "high": "x < 7"}).orderBy("step_no").collect()
    assert [tuple(r)[1:] for r in rows] == [("low", 10, 8, 2), ("high", 8, 5, 3)]


def test_guards(spark):
    df = spark.createDataFrame([(2, None), (3, 1.0), (None, None)], "h int, x double")
    good, bad = check_domain(df, "h", [2, 4, 6, 8])
    assert (good.count(), bad.count()) == (1, 2)
    assert require_any(df, ["x"]).count() == 1
    with pytest.raises(ValueError):
        require_rows(df.where("h > 5"), "x")


def test_alert_limits_are_strict(spark):
    rows = [(0.19, 0.19), (0.20, 0.20), (0.70, 0.70), (0.71, 0.71), (0.5, 0.4), (0.5, 0.39), (None, 0.5)]
    df = spark.createDataFrame([(i, p, c, 4) for i, (p, c) in enumerate(rows)], "id int, p double, c double, horizon_hours int")
    out = classify_alert(df, "p", "c").orderBy("id").collect()
    assert [r["alert"] for r in out] == ["RED", "GREEN", "GREEN", "RED", "GREEN", "YELLOW", None]
    assert out[3]["alert_msg"] == "KRİTİK: 4h sonrası Si tahmini (0.71) sınırlar dışında."
    assert out[5]["alert_msg"] == "UYARI: 4h içinde +0.1100 sapma bekleniyor."


def test_sample_is_repeatable_and_prefers_known_rows(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1.0) for i in range(600)], "id int, y double")
    a = {r["id"] for r in sample_n(df, 50, ["id"], prefer="y").collect()}
    b = {r["id"] for r in sample_n(df.repartition(5), 50, ["id"], prefer="y").collect()}
    assert a == b and len(a) == 50 and all(i % 2 == 0 for i in a)
    assert sample_n(df, 1000, ["id"]).count() == 600
    few = df.withColumn("y", F.when(F.col("id") < 20, 1.0))
    assert sample_n(few, 1000, ["id"], prefer="y").count() == 600


def test_serving_uses_the_newest_history_row(spark):
    t = [datetime(2024, 1, 1, h) for h in range(4)]
    history = spark.createDataFrame([(1, t[0], 1.0, 10.0), (1, t[2], 3.0, 30.0)], "k int, t timestamp_ntz, x double, m double")
    incoming = spark.createDataFrame([(1, t[3], 5.0), (2, t[3], 5.0)], "k int, t timestamp_ntz, x double")
    out = serve_features(history, incoming, "t", ["x"], ["m"], ["k"]).orderBy("k").collect()
    assert (out[0]["m"], out[0]["x_lag_1h"], out[0]["x_diff_1h"]) == (30.0, 3.0, 2.0)
    assert out[0]["x_velocity"] == pytest.approx(2.0, rel=1e-4)
    assert out[1]["m"] is None and out[1]["x_velocity"] is None
