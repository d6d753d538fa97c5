"""Drift of a forecast as a stored history that grows with the scored rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import drift
from ..sources.files import read_table, write_table


def high_water_mark(spark: SparkSession, path: str) -> date | None:
    """The latest day of the history; None if there is none. Reads the partition column only."""
    try:
        return read_table(spark, path).agg(F.max("day")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update_drift_history(
    scored: DataFrame,
    path: str,
    ts: str,
    pred: str,
    actual: str,
    baseline_mae: float,
    abs_limit: float,
    rel: float = 0.25,
    window_days: int = 7,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    reopen_days: int = 0,
) -> DataFrame:
    """The history after the scored rows since its latest day were added, as it is stored: the rows of ``drift``
    partitioned by ``day``.

    The latest day may have been incomplete, so it is made anew, and with ``reopen_days`` as many days before it,
    for rows that come late. Of ``scored`` only these days and the rows in their look-back are read. Days are
    replaced whole, so a repeated or restarted run leaves the same history. Rows without a time have no day
    and are left out; a column named ``day`` is replaced.
    """
    spark, kind = scored.sparkSession, scored.schema[ts].dataType
    scored = scored.drop("day").where(F.col(ts).isNotNull())
    mark = high_water_mark(spark, path)
    since = None if mark is None else mark - timedelta(days=reopen_days)
    if since is not None:
        scored = scored.where(F.col(ts) >= F.lit(since - timedelta(days=window_days)).cast(kind))
    rated = drift(scored, ts, pred, actual, baseline_mae, abs_limit, rel, window_days, keys, tie)
    if since is not None:
        rated = rated.where(F.col(ts) >= F.lit(since).cast(kind))
    write_table(rated.withColumn("day", F.to_date(ts)), path, partition_by=["day"], dynamic=True)
    return read_table(spark, path)
