"""Correlations of many columns in one pass, and the history of drift."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators.stats import corr_matrix, drift
from seriesloom.plans.monitoring import high_water_mark, update_drift_history


def test_matrix_against_each_pair(spark):
    rng, nan = random.Random(1), float("nan")
    rows = []
    for i in range(400):
        x = rng.gauss(0, 1)
        rows.append((x, 1e9 + x + rng.gauss(0, 1), None if i % 3 else -x, nan if i % 5 else x * x, 7.25, i, None, 1.0 if i == 3 else None))
    cols = "a b c d constant whole never once".split()
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, constant double, whole int, never double, once double").repartition(5)
    got = {(r.a, r.b): r["corr"] for r in corr_matrix(df, cols).collect()}
    assert len(got) == len(cols) ** 2
    for (a, b), v in got.items():
        both = [(r[cols.index(a)], r[cols.index(b)]) for r in rows]
        x, y = (np.array(side, float) for side in zip(*[p for p in both if not any(q is None or q != q for q in p)] or [(0, 0)]))
        if len(x) < 2 or not np.ptp(x) or not np.ptp(y):
            assert v is None
        else:
            assert v == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    assert got["whole", "whole"] == pytest.approx(1.0)
    assert {r["corr"] for r in corr_matrix(df.limit(0), cols).collect()} == {None}


def test_history_grows_by_increments(spark, tmp_path):
    rng, start = random.Random(2), datetime(2024, 3, 1)
    rows = [(i, start + timedelta(minutes=37 * i), rng.random(), rng.random() * (1 + i / 400)) for i in range(900)]
    rows.append((900, None, 0.5, 0.5))
    df = spark.createDataFrame(rows, "id int, ts timestamp, pred double, actual double").repartition(3)
    path, limits = str(tmp_path / "history"), {"baseline_mae": 0.3, "abs_limit": 0.6}
    assert high_water_mark(spark, path) is None
    counts = []
    for n in (250, 251, 600, 600, 901):
        history = update_drift_history(df.where(F.col("id") < n), path, "ts", "pred", "actual", **limits)
        counts.append(history.count())
    assert counts == [250, 251, 600, 600, 900]
    assert high_water_mark(spark, path) == rows[899][1].date()
    want = drift(df.where("ts is not null"), "ts", "pred", "actual", **limits)
    whole = {r.id: (r.rolling_mae, r.drift) for r in want.collect()}
    found = {r.id: (r.rolling_mae, r.drift) for r in history.collect()}
    assert found.keys() == whole.keys() and {d for _, d in whole.values()} == {0, 1}
    assert all(found[i][0] == pytest.approx(whole[i][0]) and found[i][1] == whole[i][1] for i in whole)


def test_late_rows_come_in_while_days_are_open(spark, tmp_path):
    start = datetime(2024, 3, 1)
    rows = [(i, start + timedelta(hours=8 * i), 0.0, float(i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, ts timestamp, pred double, actual double")
    for days, late in ((0, False), (3, True)):
        path = str(tmp_path / f"history{days}")
        first = update_drift_history(df.where("id <> 55"), path, "ts", "pred", "actual", 1.0, 9.0)
        assert first.count() == 59
        again = update_drift_history(df, path, "ts", "pred", "actual", 1.0, 9.0, reopen_days=days)
        assert bool(again.where("id = 55").count()) is late
