"""One row per group, first and last rows, top-k and tagged unions. Orders are always total."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each group. Spark keeps one row per group and task before the shuffle, so a
    group with many copies costs no more than a small one."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, none for a NULL key."""
    return first_per(df.na.drop(subset=list(keys)), keys, order)


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in ascending order."""
    return df.orderBy(*_order(order)).limit(n)


def tail_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last ``n`` rows in ascending order (returned latest first)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the greatest ``by``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *_order(tie)).limit(k)


def with_tag(df: DataFrame, value: str, name: str = "source_type") -> DataFrame:
    """Add a constant tag that names the data set a row came from."""
    return df.withColumn(name, F.lit(value))


def union_tagged(frames: dict[str, DataFrame], name: str = "source_type") -> DataFrame:
    """Union of data sets, each row tagged; columns a data set lacks are NULL."""
    tagged = [with_tag(df, tag, name) for tag, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def sample_n(
    df: DataFrame,
    n: int,
    ids: Sequence[str],
    seed: int = 42,
    prefer: str | None = None,
    prefer_min: int = 100,
) -> DataFrame:
    """At most ``n`` rows, chosen by the smallest MD5 of seed and ``ids``: the same rows on every run.

    With ``prefer`` (off by default), the choice is among the rows whose ``prefer`` is known if these are more
    than ``prefer_min``.
    """
    if prefer is not None:
        known = df.where(F.col(prefer).isNotNull())
        if len(known.select(prefer).take(prefer_min + 1)) > prefer_min:
            df = known
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])), *ids).limit(n)
