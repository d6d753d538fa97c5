"""As-of join against a brute-force search."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seriesloom.operators.asof import asof_drift, asof_join

T0 = datetime(2024, 1, 1)


def frames(spark, left, right):
    lf = spark.createDataFrame([(k, i, T0 + timedelta(seconds=s)) for i, (k, s) in enumerate(left)], "k int, id int, t timestamp_ntz")
    rf = spark.createDataFrame(
        [(k, i, T0 + timedelta(seconds=s)) for i, (k, s) in enumerate(right)], "k int, rid int, rt timestamp_ntz"
    )
    return lf, rf


def brute(left, right, direction, tolerance):
    out = []
    for k, s in left:
        best = None
        for rid, (rk, rs) in enumerate(right):
            gap = s - rs if direction == "backward" else rs - s
            if rk != k or gap < 0 or (tolerance is not None and gap > tolerance):
                continue
            rank = (gap, -rid if direction == "backward" else rid)
            best = min(best, (rank, rid)) if best else (rank, rid)
        out.append(best[1] if best else None)
    return out


pairs = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5000)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs, st.sampled_from(["backward", "forward"]), st.sampled_from([None, 600]), st.sampled_from([3, None]))
def test_matches_brute_force(spark, left, right, direction, tolerance, max_rows):
    lf, rf = frames(spark, left, right)
    got = asof_join(lf, rf, "t", "rt", ["k"], direction, tolerance, tie=["rid"], width_s=900, max_rows=max_rows)
    assert [r["rid"] for r in got.orderBy("id").collect()] == brute(left, right, direction, tolerance)


def test_edges(spark):
    lf, rf = frames(spark, [(0, 5), (0, 10), (0, 99)], [(0, 10), (0, 10), (0, 20)])
    got = asof_join(lf, rf, "t", "rt", ["k"], tie=["rid"])
    assert [r["rid"] for r in got.orderBy("id").collect()] == [None, 1, 2]
    drift = asof_drift(got, "t", "rt").orderBy("id").collect()
    assert [r["drift_min"] for r in drift] == [None, 0.0, pytest.approx(79 / 60)]


def test_hot_time_is_shared_out(spark):
    """Many left rows at one time: they are spread over tasks and all get the same match."""
    lf, rf = frames(spark, [(0, 50)] * 500 + [(0, 51), (1, 50)], [(0, 10), (0, 50), (1, 60)])
    got = asof_join(lf, rf, "t", "rt", ["k"], tie=["rid"], max_rows=20)
    assert [r["rid"] for r in got.orderBy("id").collect()] == [1] * 501 + [None]


def test_shared_column_names_are_refused(spark):
    lf, rf = frames(spark, [(0, 1)], [(0, 1)])
    with pytest.raises(ValueError):
        asof_join(lf, rf.withColumnRenamed("rid", "id"), "t", "rt", ["k"])


def test_copies_at_a_hot_time_are_kept(spark):
    lf, rf = frames(spark, [(0, 50)] * 3 + [(0, 60)], [(0, 50), (0, 50)])
    lf = lf.withColumn("id", lf.id * 0)
    got = asof_join(lf.union(lf).union(lf), rf, "t", "rt", ["k"], tie=["rid"], max_rows=4)
    assert [r["rid"] for r in got.collect()] == [1] * 12
