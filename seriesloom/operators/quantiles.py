"""Exact quantiles (linear interpolation) of tables too large for one aggregation buffer, and trimming.

Spark's exact ``percentile`` keeps every distinct value of a group in one task. Here each quantile is bracketed
with the mergeable approximate sketch, rows below the bracket are counted, and the bracket is narrowed until the
values inside it are few enough to be ranked. Every pass is a map-side reduced aggregation. How few is a size of
work and never changes the answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nan_to_null

DIRECT_ROWS = 20_000
_ACCURACY = 10_000


@dataclass(frozen=True)
class _Range:
    """Values known to hold one wanted rank: ``below`` lie under lo, ``inside`` between lo and hi."""

    lo: float | None
    hi: float | None
    below: int
    inside: int

    def holds(self, c: str) -> Column:
        parts = [F.col(c).isNotNull()]
        if self.lo is not None:
            parts.append(F.col(c) >= F.lit(self.lo))
        if self.hi is not None:
            parts.append(F.col(c) <= F.lit(self.hi))
        return reduce(and_, parts)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], direct_rows: int = DIRECT_ROWS
) -> dict[str, list[float | None]]:
    """Quantiles of each column, NULL and NaN ignored: {column: [value per probability]}.

    A bracket of at most ``direct_rows`` values is ranked as it is.
    """
    probs, cols = list(probs), list(cols)
    df = nan_to_null(df.select(*dict.fromkeys(cols)), cols)
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict()

    def ranks(c: str, p: float) -> tuple[int, int, float]:
        at = (counts[c] - 1) * p
        return int(at), min(int(at) + 1, counts[c] - 1), at - int(at)

    wanted = sorted({(c, r) for c in cols if counts[c] for p in probs for r in ranks(c, p)[:2]})
    found = _order_statistics(df, wanted, counts, direct_rows)

    def value(c: str, p: float) -> float | None:
        if not counts[c]:
            return None
        lo, hi, part = ranks(c, p)
        return found[c, lo] + (found[c, hi] - found[c, lo]) * part

    return {c: [value(c, p) for p in probs] for c in cols}


def _order_statistics(
    df: DataFrame, wanted: list[tuple[str, int]], counts: dict[str, int], direct_rows: int
) -> dict[tuple[str, int], float]:
    """Value at each wanted (column, 0-based rank)."""
    whole = {(c, r): _Range(None, None, 0, counts[c]) for c, r in wanted}
    ready = {k: g for k, g in whole.items() if g.inside <= direct_rows}
    ranges = {k: g for k, g in whole.items() if k not in ready}
    halved: set[tuple[str, int]] = set()  # the sketch no longer narrows these
    while ranges:
        asked = list(ranges)
        shared: dict[tuple[str, _Range], list[int]] = {}
        for i, (c, r) in enumerate(asked):
            shared.setdefault((c, ranges[c, r]), []).append(i)
        sketches = []
        for (c, g), members in shared.items():
            ends: list[float] = []
            for i in members:
                share, slack = (asked[i][1] - g.below + 0.5) / g.inside, 2.0 / _ACCURACY
                ends += [max(0.0, share - slack), min(1.0, share + slack)]
            values = F.when(g.holds(c), F.col(c))
            sketches.append(F.percentile_approx(values, F.array(*[F.lit(e) for e in ends]), _ACCURACY))
        cuts: dict[int, tuple[float, float]] = {}
        for members, got in zip(shared.values(), df.agg(*sketches).first()):
            cuts.update({i: (got[2 * j], got[2 * j + 1]) for j, i in enumerate(members)})
        for i, k in enumerate(asked):
            if k in halved and ranges[k].lo is not None and ranges[k].hi is not None:
                middle = float(ranges[k].lo) / 2 + float(ranges[k].hi) / 2
                cuts[i] = (middle, middle)
        # each distinct cut is counted once, however many ranks share it
        edges = sorted({(asked[i][0], v) for i, ab in cuts.items() for v in ab})
        counted = df.agg(
            *[F.count_if(F.col(c) < F.lit(v)) for c, v in edges],
            *[F.count_if(F.col(c) <= F.lit(v)) for c, v in edges],
        ).first()
        tally = {e: (counted[k], counted[k + len(edges)]) for k, e in enumerate(edges)}
        for i, (c, r) in enumerate(asked):
            g, (a, b) = ranges.pop((c, r)), cuts[i]
            (lt_a, le_a), (lt_b, le_b) = tally[c, a], tally[c, b]
            if r < lt_a:
                new = _Range(g.lo, a, g.below, le_a - g.below)
            elif r < le_b:
                new = _Range(a, b, lt_a, le_b - lt_a)
            else:
                new = _Range(b, g.hi, lt_b, g.below + g.inside - lt_b)
            if new.inside == g.inside:
                halved.add((c, r))
            # between neighbouring numbers there is nothing left to halve
            stuck = (c, r) in halved and (new.lo, new.hi) == (g.lo, g.hi)
            settled = new.inside <= direct_rows or new.lo == new.hi or stuck
            (ready if settled else ranges)[c, r] = new

    spans = list(dict.fromkeys((c, g) for (c, _), g in ready.items()))
    inside = F.array(
        *[
            F.when(g.holds(c), F.struct(F.lit(k).alias("id"), F.col(c).cast("double").alias("v")))
            for k, (c, g) in enumerate(spans)
        ]
    )
    upto = F.sum("count").over(Window.partitionBy("id").orderBy("v"))
    ranked = df.select(F.inline(F.array_compact(inside))).groupBy("id", "v").count().withColumn("upto", upto)
    place = {(c, r): (spans.index((c, g)), r - g.below) for (c, r), g in ready.items()}
    offsets: dict[int, set[int]] = {}
    for k, offset in place.values():
        offsets.setdefault(k, set()).add(offset)
    # the values whose run of copies covers one of the wanted places
    hits = reduce(
        or_,
        [
            (F.col("id") == k) & (F.col("upto") > o) & (F.col("upto") - F.col("count") <= o)
            for k, os in offsets.items()
            for o in os
        ],
    )
    runs = ranked.where(hits).collect()
    return {
        key: next(x["v"] for x in runs if x["id"] == k and x["upto"] - x["count"] <= o < x["upto"])
        for key, (k, o) in place.items()
    }


def quantile_bounds(
    df: DataFrame,
    cols: Sequence[str],
    lo: float,
    hi: float,
    approx: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, tuple[float, float]]:
    """Lower and upper quantile per column; a pair of numbers each, whatever the table size."""
    if approx:
        q = F.array(F.lit(lo), F.lit(hi))
        known = nan_to_null(df, list(cols))
        row = known.agg(*[F.percentile_approx(c, q, _ACCURACY).alias(c) for c in cols]).first()
        return {c: (None, None) if row[c] is None else tuple(row[c]) for c in cols}
    return {c: tuple(v) for c, v in exact_quantiles(df, cols, [lo, hi], direct_rows).items()}


def inside_bounds(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """True where every column lies within its bounds. The bounds are literals, so the scan can use them.

    A column without values has no bounds and excludes nothing.
    """
    known = [F.col(c).between(F.lit(a), F.lit(b)) for c, (a, b) in bounds.items() if a is not None]
    return reduce(and_, known, F.lit(True))


def trim_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    lo: float = 0.01,
    hi: float = 0.99,
    bounds_from: DataFrame | None = None,
    approx: bool = False,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Keep the rows inside the [lo, hi] quantile range of every column.

    The quantiles are those of ``bounds_from`` when given, else of the frame itself.
    """
    source = df if bounds_from is None else bounds_from
    return df.where(inside_bounds(quantile_bounds(source, cols, lo, hi, approx, direct_rows)))
