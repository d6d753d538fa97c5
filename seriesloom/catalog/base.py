"""Registry, table access and the plant tables that the queries derive from ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.furnace import CONTRACT, TP, TT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Rounding for the comparison of two engines, as the same double arithmetic on both sides. The cut lies
# a little off the half, so that values with few decimals never fall on it.


def rounded(x: str | Column, digits: int = 6) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x * F.lit(10.0**digits) + F.lit(0.5003)) / F.lit(10.0**digits)


def rounded_sql(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5003e0) / 1e{digits}"


def round_all(df: DataFrame, cols: dict[str, int] | list[str], digits: int = 6) -> DataFrame:
    chosen = cols if isinstance(cols, dict) else dict.fromkeys(cols, digits)
    return df.select(
        *[rounded(c, chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def round_all_sql(cols: dict[str, int] | list[str], digits: int = 6) -> str:
    chosen = cols if isinstance(cols, dict) else dict.fromkeys(cols, digits)
    return ", ".join(f"{rounded_sql(c, d)} as {c}" for c, d in chosen.items())


# Plant readings derived from events: expressions that mean the same in Spark SQL and in the oracle's SQL.
PLANT: dict[str, str] = {
    "Fb": "2000e0 + 10e0 * value",
    "Th": "900e0 + event_id * 37 % 400",
    "Tc": "60e0 + user_id * 13 % 100",
    "Fo": "case when event_type = 'error' and event_id % 3 = 0 then null else 15000e0 + event_id * 101 % 8000 end",
    "R": "15e-1 + user_id % 8 * 6e-1",
    "Ph": "3e0 + event_id % 7 * 1e-1",
    "Pc": "25e-1 + event_id % 5 * 1e-1",
    "Pt": "12e-1 + user_id % 3 * 1e-1",
    "dP": "case when event_type = 'signup' and event_id % 5 = 0 then -1e0 else 1e0 + event_id % 11 * 1e-1 end",
    "dPu": "4e-1 + event_id % 11 * 4e-2",
    "dPl": "6e-1 + event_id % 11 * 6e-2",
    "CO2": "15e0 + value % 10e0",
    "H2": "3e0 + user_id % 7 * 5e-1",
    **{c: f"100e0 + event_id * {i + 2} % 60" for i, c in enumerate(TT, 1)},
    **{c: f"250e0 + event_id * {i + 6} % 90 + user_id % 10" for i, c in enumerate(TP, 1)},
}
SILICON = "2e-1 + value / 200e0"
TAG = "case when event_type in ('click', 'view') then 'first' else 'second' end"
LINE = "user_id % 5"

assert list(PLANT) == CONTRACT.sensors

SENSOR_SQL = (
    f"select {LINE} as line, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as dt, "
    + ", ".join(f"{e} as {c}" for c, e in PLANT.items())
    + f", {TAG} as source_type, event_id from events"
)
TARGET_SQL = (
    f"select {LINE} as line, strftime(ts, '%Y-%m-%d %H:%M:%S') as dt, {SILICON} as Si, {TAG} as source_type, "
    "event_id from events where event_type = 'purchase'"
)


def plant_sensors(spark: SparkSession, sf: str, keyed: bool = False) -> DataFrame:
    """Raw sensor readings, one per event; time as text with whole minutes, so that some coincide."""
    at = F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        *([F.expr(LINE).alias("line")] if keyed else []),
        at.alias("dt"),
        *[F.expr(e).alias(c) for c, e in PLANT.items()],
        F.expr(TAG).alias("source_type"),
        "event_id",
    )


def plant_targets(spark: SparkSession, sf: str, keyed: bool = False) -> DataFrame:
    """Irregular target measurements: one per purchase."""
    return (
        table(spark, sf, "events")
        .where("event_type = 'purchase'")
        .select(
            *([F.expr(LINE).alias("line")] if keyed else []),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt"),
            F.expr(SILICON).alias("Si"),
            F.expr(TAG).alias("source_type"),
            "event_id",
        )
    )
