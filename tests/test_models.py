"""Forecasting, attribution and anomaly detection on small made series with known structure."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.models.forecast import (
    HorizonModel,
    best_params,
    expanding_cv,
    feature_importance,
    fit_one,
    holdout,
    permutation_importance,
    retrain_if_drift,
    scenario_frame,
    score,
    score_scenarios,
)
from seriesloom.models.forest import fit_forest, isolation_forest
from seriesloom.plans.furnace import DEFAULTS, SCENARIO_SENSORS, SCENARIOS

SMALL = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    a, b = rng.uniform(size=400), rng.uniform(size=400)
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(hours=i), float(x), float(y), float(0.3 + 0.4 * x)) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "t timestamp_ntz, a double, b double, y double").cache()


@pytest.fixture(scope="module")
def model(frame):
    return HorizonModel(2, ("a", "b"), fit_one(frame, ["a", "b"], "y", **SMALL))


def test_holdout_is_the_latest_part(frame):
    train, test = holdout(frame, "t", 0.25)
    assert (train.count(), test.count()) == (300, 100)
    assert train.agg(F.max("t")).first()[0] < test.agg(F.min("t")).first()[0]


def test_expanding_folds_train_on_the_past(frame):
    grid = [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 5, "maxDepth": 3}]
    cv = expanding_cv(frame, "t", ["a", "b"], "y", grid, n_folds=2)
    rows = cv.orderBy("params_id", "fold").collect()
    assert [(r["params_id"], r["fold"], r["n"]) for r in rows] == [(0, 1, 133), (0, 2, 133), (1, 1, 133), (1, 2, 133)]
    assert best_params(cv, grid) == grid[1]


def test_scores_and_importance(spark, frame, model):
    out = score(frame, {2: model}, current="y", keep=["t"])
    assert out.where("abs(prediction - y) > 0.1").count() == 0
    assert set(out.columns) == {"t", "y", "horizon_hours", "prediction", "delta", "alert", "alert_msg", "status"}
    assert feature_importance(model, spark, 1).first()["feature"] == "a"


def test_missing_feature_counts_as_zero(frame, model):
    a = model.predict(frame.drop("b")).agg(F.sum("pred")).first()[0]
    b = model.predict(frame.withColumn("b", F.lit(None).cast("double"))).agg(F.sum("pred")).first()[0]
    assert a == b


def test_permutation_importance(frame, model):
    rows = {r["feature"]: r for r in permutation_importance(frame, model, "y", ["t"], n=200).collect()}
    assert rows["a"]["mae_increase"] > 0.05 > rows["b"]["mae_increase"]
    assert rows["a"]["direction"] > 0.9


def test_scenarios(spark, frame):
    sensors = frame.select((0.2 + F.col("a") * 0.6).alias("Si"), F.col("y"))
    model = HorizonModel(2, ("Si",), fit_one(sensors, ["Si"], "y", **SMALL))
    out = score_scenarios(scenario_frame(spark, SCENARIOS, SCENARIO_SENSORS, DEFAULTS), {2: model})
    assert out.count() == 5 and out.where("in_expected_range is null").count() == 0


def test_retraining_follows_the_latest_row(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "t int, drift int")
    assert retrain_if_drift(df, {2: None}, dict, "t") == ({2: None}, False)
    assert retrain_if_drift(df.where("t = 1"), {2: None}, dict, "t") == ({}, True)


def test_isolation_forest_finds_planted_points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(950, 2))
    x = np.vstack([x, rng.normal(loc=12, size=(50, 2))])
    df = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(x)], "id int, p double, q double")
    out = isolation_forest(df, ["p", "q"], ["id"], n_trees=50, sample=128)
    bad = [r["id"] for r in out.where("is_anomalous = -1").collect()]
    assert len(bad) == 50 and sum(i >= 950 for i in bad) >= 45
    again = isolation_forest(df.repartition(7), ["p", "q"], ["id"], n_trees=50, sample=128)
    assert sorted(r["id"] for r in again.where("is_anomalous = -1").collect()) == sorted(bad)
    many = df.crossJoin(spark.range(10).withColumnRenamed("id", "copy"))
    forest = fit_forest(many, ["p", "q"], ["id", "copy"], n_trees=20, sample=64)
    assert len(forest.trees) == 20 and all(t["size"][0] <= 64 for t in forest.trees)


def _by_subsets(tree, row):
    """Shapley values of one tree and row over all subsets of features."""
    from itertools import combinations
    from math import factorial

    def expected(node, known):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        left, right = tree.left[node], tree.right[node]
        if f in known:
            return expected(left if row[f] <= tree.split[node] else right, known)
        return (tree.cover[left] * expected(left, known) + tree.cover[right] * expected(right, known)) / tree.cover[node]

    n, out = len(row), np.zeros(len(row))
    for i in range(n):
        others = [f for f in range(n) if f != i]
        for k in range(n):
            for s in combinations(others, k):
                weight = factorial(k) * factorial(n - k - 1) / factorial(n)
                out[i] += weight * (expected(0, {*s, i}) - expected(0, set(s)))
    return expected(0, set()), out


def test_shapley_values_against_all_subsets():
    from seriesloom.models.attribution import Tree, shapley

    rng = np.random.default_rng(4)
    for _ in range(12):
        nodes = []

        def grow(cover, depth):
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1, rng.normal(), cover])
            if depth and cover > 1:
                share = int(rng.integers(1, cover))
                nodes[at][:2] = int(rng.integers(0, 4)), float(rng.integers(0, 4))  # features repeat on a path
                nodes[at][2] = grow(share, depth - 1)
                nodes[at][3] = grow(cover - share, depth - 1)
            return at

        grow(60, 5)
        c = list(zip(*nodes))
        ints = [np.array(c[i], np.int64) for i in (0, 2, 3)]
        tree = Tree(ints[0], np.array(c[1]), ints[1], ints[2], np.array(c[4]), np.array(c[5], float))
        x = rng.integers(0, 5, (7, 4)).astype(float)
        base, found = shapley([tree, tree], [1.0, 0.5], x)
        for row, values in zip(x, found):
            want_base, want = _by_subsets(tree, row)
            assert np.allclose(values, 1.5 * want) and np.isclose(base, 1.5 * want_base)


def test_tree_attribution_adds_up(frame, model):
    from seriesloom.models.attribution import attribution_summary, tree_attribution

    found = tree_attribution(model.predict(frame), model, ["t", "pred"]).collect()
    assert len(found) == 400
    assert all(abs(r["base"] + sum(r["effects"]) - r["pred"]) < 1e-9 for r in found)
    effects = np.array([r["effects"] for r in found])
    rows = {r["feature"]: r for r in attribution_summary(frame.withColumn("y", F.expr("if(a < 0.1, null, y)")), model, "y").collect()}
    assert rows["a"]["n"] == frame.where("a >= 0.1").count() < 400
    assert rows["a"]["mean_abs_effect"] > 5 * rows["b"]["mean_abs_effect"] and rows["a"]["direction"] > 0.9
    whole = {r["feature"]: r["mean_abs_effect"] for r in attribution_summary(frame, model, "y").collect()}
    assert np.allclose([whole[f] for f in model.features], np.abs(effects).mean(axis=0))
