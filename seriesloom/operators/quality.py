"""Validity rules, imputation and input repair."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = str | Column


def _cond(rule: Rule) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def all_of(rules: Sequence[Rule]) -> Column:
    """Conjunction of rules; NULL counts as not satisfied."""
    return F.coalesce(reduce(and_, [_cond(r) for r in rules]), F.lit(False))


def flag_invalid(df: DataFrame, rules: Sequence[Rule], out: str = "is_outlier") -> DataFrame:
    """0 where every rule holds, 1 where one fails or cannot be decided because of a NULL."""
    return df.withColumn(out, F.when(all_of(rules), 0).otherwise(1))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that satisfy every rule."""
    return df.where(reduce(and_, [_cond(r) for r in rules]))


def rules_each(cols: Sequence[str], rule: str) -> list[str]:
    """One rule per column; ``{c}`` in the template stands for the column."""
    return [rule.format(c=c) for c in cols]


def apply_rules_each(df: DataFrame, cols: Sequence[str], rule: str) -> DataFrame:
    """Keep the rows where every column satisfies the rule template."""
    return apply_rules(df, rules_each(cols, rule))


def double_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def pool_means(df: DataFrame, cond: Rule, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with the mean of every double column over the rows of the trusted pool, NaN left out."""
    wanted = cols or double_cols(df)
    return df.where(_cond(cond)).agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in wanted])


def broadcast_row(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """Attach a one-row frame to every row as a struct column, through one scalar subquery."""
    row = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias(name))
    return df.select("*", row.scalar().alias(name))


def impute(
    df: DataFrame, cols: Sequence[str], flag: str, fill: DataFrame | Mapping[str, float | None]
) -> DataFrame:
    """Replace missing and non-positive values of flagged rows by the fill value of the column.

    NaN counts as missing and leaves as NULL in rows that are not flagged or columns without a fill value. ``fill`` is a one-row frame,
    attached lazily, or a mapping, which gives smaller generated code.
    """
    if isinstance(fill, DataFrame):
        wanted = [c for c in cols if c in fill.columns]
        source = broadcast_row(df, fill.select(*wanted), "_fill")
        value = {c: F.coalesce(F.col("_fill")[c], F.col(c)) for c in wanted}
    else:
        source = df
        value = {c: F.lit(fill[c]) for c in cols if fill.get(c) is not None}

    def repaired(c: str) -> Column:
        if c not in value:
            return F.when(~F.isnan(c), F.col(c)).alias(c)
        flagged = F.col(flag) == 1
        sound = (~flagged | (F.col(c) > 0)) & ~F.isnan(c)
        return F.when(sound, F.col(c)).when(flagged, value[c]).alias(c)

    return source.select(*[repaired(c) if c in cols else F.col(c) for c in df.columns])


def fill_missing(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Replace NULL and NaN by a constant."""
    return df.na.fill(value, subset=list(cols))


def align_columns(
    df: DataFrame, cols: Sequence[str], default: float = 0.0, keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly the columns ``cols`` (after ``keep``), with a constant for those the frame lacks."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(float(default)).alias(c) for c in cols]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default values for absent columns and for NULLs in present ones."""
    out = [
        F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
        for c in df.columns
    ]
    return df.select(*out, *[F.lit(v).alias(c) for c, v in defaults.items() if c not in df.columns])


def check_domain(df: DataFrame, col: str, allowed: Sequence) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows; a NULL is rejected."""
    inside = F.coalesce(F.col(col).isin(list(allowed)), F.lit(False))
    return df.where(inside), df.where(~inside)


def require_any(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the rows with at least one non-null value among ``cols``."""
    return df.na.drop(thresh=1, subset=list(cols))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Columns that may enter a model: all but identifiers, targets and helpers."""
    banned = set(exclude)
    return [c for c in df.columns if c not in banned]


def funnel(df: DataFrame, steps: Mapping[str, Rule]) -> DataFrame:
    """Rows before, after and removed per cleaning step, in one pass over the table."""
    passed: list[Column] = []
    counts = [F.count(F.lit(1)).alias("_n0")]
    so_far = F.lit(True)
    for i, rule in enumerate(steps.values(), 1):
        so_far = so_far & F.coalesce(_cond(rule), F.lit(False))
        counts.append(F.count_if(so_far).alias(f"_n{i}"))
    for i, name in enumerate(steps, 1):
        passed.append(
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(f"_n{i - 1}").alias("rows_before"),
                F.col(f"_n{i}").alias("rows_after"),
                (F.col(f"_n{i - 1}") - F.col(f"_n{i}")).alias("rows_removed"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*passed)))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when the frame is empty; reads no more than the first row."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df
