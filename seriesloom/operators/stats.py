"""Descriptive statistics, correlations, health, forecast metrics and drift."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null
from .blocks import DAY
from .quantiles import exact_quantiles
from .windows import Roll, rolling

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _label(p: float) -> str:
    return f"p{round(p * 100, 6):g}"


def summarize(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Quantiles per column, one row per column and probability."""
    values = exact_quantiles(df, cols, probs)
    rows = [(c, float(p), v) for c in cols for p, v in zip(probs, values[c])]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def describe(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99),
    digits: int | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, min, max and quantiles: one row per column, NULL and NaN left out."""
    df = nan_to_null(df, list(cols))

    def shown(x: Column) -> Column:
        x = x.cast("double")
        return x if digits is None else F.round(x, digits)

    base = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                shown(F.avg(c)).alias("mean"),
                shown(F.stddev_samp(c)).alias("std"),
                shown(F.min(c)).alias("min"),
                shown(F.max(c)).alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    values = exact_quantiles(df, cols, probs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(c)[s].alias(s) for s in ("count", "mean", "std", "min", "max")],
            *[shown(F.lit(v)).alias(_label(p)) for p, v in zip(probs, values[c])],
        )
        for c in cols
    ]
    return base.select(F.inline(F.array(*rows)))


def corr(df: DataFrame, a: str, b: str, out: str = "corr") -> DataFrame:
    """Pearson correlation of two columns, in one row; pairs with a NULL or NaN are left out."""
    return nan_to_null(df, [a, b]).agg(F.corr(a, b).alias(out))


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def co_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For each pair of columns (``i`` <= ``j``, their places): rows with both values, and the sums of x, y, their
    squares and their product over these rows.

    Values are taken relative to a value near the middle of their column, which keeps the sums free of
    cancellation and those of a constant column at zero. A task adds up matrix products of its Arrow batches and
    sends one row a pair, whatever the number of rows; Spark adds these up, combined before the shuffle. NULL and
    NaN are no values.
    """
    cols = list(cols)
    df = nan_to_null(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]), [f"c{i}" for i in range(len(cols))])
    middles = df.agg(*[F.percentile_approx(c, 0.5, 1000).alias(c) for c in df.columns]).first()
    middle = np.array([0.0 if m is None or not np.isfinite(m) else m for m in middles])
    left, right = np.triu_indices(len(cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(middle), len(middle))) for _ in _MOMENTS]
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - middle
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            first, second = x.T @ m, (x * x).T @ m
            for total, part in zip(sums, (m.T @ m, first, first.T, second, second.T, x.T @ x)):
                total += part
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (left.astype(np.int32), right.astype(np.int32), *(s[left, right] for s in sums))], ["i", "j", *_MOMENTS]
        )

    parts = df.mapInArrow(run, "i int, j int, " + ", ".join(f"{c} double" for c in _MOMENTS))
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _MOMENTS])


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs (a, b, corr), both directions and the diagonal, in one pass; NULL and NaN are left out pair by
    pair. A pair has no correlation (NULL) with less than two rows, or if a column is constant or infinite there."""
    names = F.array(*[F.lit(c) for c in cols])
    x, y = (F.col("n") * F.col(f"s{v}{v}") - F.col(f"s{v}") * F.col(f"s{v}") for v in "xy")
    both = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    value = F.when((F.col("n") > 1) & (x > 0) & (y > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), both / (F.sqrt(x) * F.sqrt(y)))))
    pairs = co_moments(df, cols).select("i", "j", F.nanvl(value, F.lit(None).cast("double")).alias("corr"))
    k, at = len(cols), F.col("id").cast("int")
    cells = df.sparkSession.range(k * k).select((at / k).cast("int").alias("a"), (at % k).alias("b"))
    cells = cells.withColumns({"i": F.least("a", "b"), "j": F.greatest("a", "b")}).join(pairs, ["i", "j"], "left")
    return cells.select(F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), "corr")


def rank_by_corr(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Columns ordered by their correlation with the target, greatest first."""
    others = [c for c in cols if c != target]
    df = nan_to_null(df, [*others, target])
    agg = df.agg(*[F.corr(c, target).alias(c) for c in others])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in others]
    return agg.select(F.inline(F.array(*cells))).orderBy(F.col("corr").desc_nulls_last(), "column")


def count_where(df: DataFrame, **conds: str) -> DataFrame:
    """Number of rows per named condition, in one row."""
    return df.agg(*[F.count_if(F.expr(c)).alias(name) for name, c in conds.items()])


def health(df: DataFrame, flag: str, bad: int = -1) -> DataFrame:
    """Rows, anomalies, anomaly rate and health in percent."""
    n, hits = F.count(F.lit(1)), F.count_if(F.col(flag) == bad)
    return df.agg(n.alias("total"), hits.alias("anomalies")).select(
        "total",
        "anomalies",
        F.try_divide("anomalies", "total").alias("anomaly_rate"),
        ((F.lit(1.0) - F.try_divide("anomalies", "total")) * 100).alias("health_pct"),
    )


def forecast_metrics(
    df: DataFrame, pred: str, actual: str, naive: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R2 of a forecast; with ``naive`` also its MAE and the gain over it in percent."""
    err = F.col(pred) - F.col(actual)
    known = df.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(actual) * F.count(F.lit(1))).alias("_sst"),
    ]
    out = [*by, "n", "mae", "rmse", (F.lit(1.0) - F.try_divide("_sse", "_sst")).alias("r2")]
    if naive is not None:
        aggs.append(F.avg(F.abs(F.col(naive) - F.col(actual))).alias("naive_mae"))
        gain = F.try_divide(F.col("naive_mae") - F.col("mae"), F.col("naive_mae")) * 100
        out += ["naive_mae", gain.alias("improvement_pct")]
    return known.groupBy(*by).agg(*aggs).select(*out)


def naive_forecast(df: DataFrame, col: str, out: str = "naive") -> DataFrame:
    """Last known value as the forecast."""
    return df.withColumn(out, F.col(col))


def drift(
    df: DataFrame,
    ts: str,
    pred: str,
    actual: str,
    baseline_mae: float,
    abs_limit: float,
    rel: float = 0.25,
    window_days: int = 7,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Rolling MAE per row and a drift flag: above ``abs_limit``, or worse than the baseline by ``rel``."""
    scored = df.withColumn("abs_err", F.abs(F.col(pred) - F.col(actual)))
    rolled = rolling(scored, ts, [Roll("rolling_mae", "abs_err", "avg", window_days * DAY)], keys, tie)
    mae = F.col("rolling_mae")
    over = (mae > F.lit(abs_limit)) | (mae > F.lit(baseline_mae * (1 + rel)))
    return rolled.withColumn("drift", F.coalesce(over, F.lit(False)).cast("int"))
