"""Silver, feature and cleaning plans."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from seriesloom.catalog.base import plant_sensors, plant_targets
from seriesloom.operators.blocks import DAY, HOUR
from seriesloom.operators.quality import feature_columns
from seriesloom.plans.audit import Layer, audit
from seriesloom.plans.cleaning import clean_cascade, cleaning_funnel
from seriesloom.plans.features import build_features
from seriesloom.plans.furnace import CLEANING, CONTRACT, FEATURES, FURNACE, NOT_FEATURES
from seriesloom.plans.silver import build_silver
from seriesloom.sources.staging import staged

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def silver(spark, sf):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return staged(build_silver(plant_sensors(spark, sf), plant_targets(spark, sf), FURNACE))


def test_silver_is_complete_and_unique(silver):
    assert silver.columns == ["si_dt", "Si", *CONTRACT.sensors]
    assert silver.na.drop().count() == silver.count() == silver.select("si_dt").distinct().count()


def test_feature_table_has_the_contracted_columns(silver):
    gold = build_features(silver, FEATURES)
    assert len(gold.columns) == 122 and gold.columns == list(FEATURES.order)
    assert len(feature_columns(gold, NOT_FEATURES)) == 122 - 7


def test_features_do_not_depend_on_the_block_width(silver):
    wide = build_features(silver, FEATURES, deduplicate=False).orderBy("si_dt").collect()
    narrow = build_features(silver, FEATURES, deduplicate=False, width_s=2 * DAY).orderBy("si_dt").collect()
    tiny = build_features(silver, FEATURES, deduplicate=False, width_s=5 * HOUR).orderBy("si_dt").collect()
    assert len(wide) == len(narrow) == len(tiny) > 0
    for a, b, c in zip(wide, narrow, tiny):
        for other in (b, c):
            assert a["si_dt"] == other["si_dt"]
            assert list(a)[1:-6] == pytest.approx(list(other)[1:-6], nan_ok=True)
            assert list(a)[-6:] == list(other)[-6:]


def test_duplicate_hours_are_removed(silver):
    twice = silver.unionByName(silver)
    a = build_features(twice, FEATURES).count()
    assert a == build_features(silver, FEATURES, deduplicate=False).count()


def test_latest_target_and_trusted_tag_win(spark):
    names = CONTRACT.sensors
    base = dict.fromkeys(names, 1.0)
    sensors = [
        ("2024-01-01 00:10:00", *(base | {"Fb": 10.0}).values(), "first"),
        ("2024-01-01 00:10:00", *(base | {"Fb": 20.0}).values(), "second"),
        ("2024-01-01 00:40:00", *(base | {"Fb": 40.0}).values(), "first"),
        ("not a time", *base.values(), "first"),
    ]
    targets = [("2024-01-01 00:05:00", 0.1), ("2024-01-01 00:55:00", 0.9), ("2024-01-01 07:00:00", 0.5)]
    schema = "dt string, " + ", ".join(f"{c} double" for c in names) + ", source_type string"
    out = build_silver(
        spark.createDataFrame(sensors, schema), spark.createDataFrame(targets, "dt string, Si double"), FURNACE
    ).collect()
    assert [(r["si_dt"], r["Si"], r["Fb"]) for r in out] == [(T0, 0.9, 30.0)]


def test_cascade_and_funnel_agree(spark, silver):
    rows = cleaning_funnel(silver, CLEANING).orderBy("step_no").collect()
    assert [r["step"] for r in rows] == ["feed", "pressure", "gas", "thermal", "target"]
    assert all(a["rows_after"] == b["rows_before"] for a, b in zip(rows, rows[1:]))
    assert clean_cascade(silver, CLEANING).count() == rows[-1]["rows_after"]
    # bounds found by narrowing, as on a large table, are the same
    assert clean_cascade(silver, CLEANING[:3], direct_rows=20).count() == rows[2]["rows_after"]


def test_audit(spark):
    df = spark.createDataFrame([(T0 + timedelta(hours=i), float(i)) for i in range(5)], "t timestamp_ntz, v double")
    got = {r["metric"]: r["value"] for r in audit({"x": Layer(df, "t", "v")}).collect()}
    assert got["rows"] == 5 and got["columns"] == 2 and got["value_p50"] == 2 and got["hours_p100"] == 1


def test_generated_methods_of_the_silver_plan_are_compiled(spark, sf):
    """The JVM leaves methods above 8,000 bytes of bytecode interpreted."""
    from seriesloom.catalog import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["silver_build"](spark, sf)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert sizes and max(sizes) <= 8000, sizes
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
