"""Windowed features: row lags, time-range rolling values, differences, velocity and future targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import epoch_s, epoch_us, nan_to_null, safe_ratio
from .blocks import HOUR, Frames, Stage, over_blocks


@dataclass(frozen=True)
class Roll:
    """One rolling value: ``fn`` of ``col`` over [t - back_s, t + fwd_s]."""

    out: str
    col: str
    fn: str
    back_s: int
    fwd_s: int = 0


_PLAIN = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "sum": lambda c: F.sum(F.col(c).cast("double")),
    "count": F.count,
    "min": F.min,
    "max": F.max,
}


# --- stages: window expressions that over_blocks() evaluates inside its blocks -------------------


def lag_stage(lags: Mapping[str, Sequence[int]], name: str = "{col}_lag_{n}h") -> Stage:
    def build(f: Frames) -> dict[str, Column]:
        return {
            name.format(col=c, n=n): F.lag(c, n).over(f.rows) for c, ns in lags.items() for n in ns
        }

    return build


def roll_stage(rolls: Sequence[Roll]) -> Stage:
    def build(f: Frames) -> dict[str, Column]:
        out = {}
        for r in rolls:
            w = f.between(-r.back_s, r.fwd_s)
            out[r.out] = (
                F.last(r.col, ignorenulls=True).over(w) if r.fn == "last" else _PLAIN[r.fn](r.col).over(w)
            )
        return out

    return build


def diff_stage(cols: Sequence[str]) -> Stage:
    """First difference and relative change against the previous row."""

    def build(f: Frames) -> dict[str, Column]:
        out = {}
        for c in cols:
            prev = F.lag(c).over(f.rows)
            out[f"{c}_diff_1h"] = F.col(c) - prev
            out[f"{c}_diff_pct"] = safe_ratio(F.col(c) - prev, prev)
        return out

    return build


def elapsed_stage(out: str = "delta_t_hours") -> Stage:
    """Hours since the previous row."""

    def build(f: Frames) -> dict[str, Column]:
        return {out: (F.col(f.sec) - F.lag(f.sec).over(f.rows)) / F.lit(3600.0)}

    return build


def velocity_stage(cols: Mapping[str, str]) -> Stage:
    """Change per hour; ``cols`` maps the output prefix to the column."""

    def build(f: Frames) -> dict[str, Column]:
        hours = (F.col(f.sec) - F.lag(f.sec).over(f.rows)) / F.lit(3600.0)
        return {
            f"{p}_velocity": safe_ratio(F.col(c) - F.lag(c).over(f.rows), hours) for p, c in cols.items()
        }

    return build


def acceleration_stage(prefixes: Sequence[str]) -> Stage:
    """Change of velocity per hour; runs after the velocity stage."""

    def build(f: Frames) -> dict[str, Column]:
        hours = (F.col(f.sec) - F.lag(f.sec).over(f.rows)) / F.lit(3600.0)
        return {
            f"{p}_acceleration": safe_ratio(
                F.col(f"{p}_velocity") - F.lag(f"{p}_velocity").over(f.rows), hours
            )
            for p in prefixes
        }

    return build


def lead_stage(ts: str, next_ts: str, hours: str) -> Stage:
    """Time of the next row and hours until it."""

    def build(f: Frames) -> dict[str, Column]:
        return {
            next_ts: F.lead(ts).over(f.rows),
            hours: (F.lead(f.sec).over(f.rows) - F.col(f.sec)) / F.lit(3600.0),
        }

    return build


def target_stage(
    col: str, horizons: Sequence[int], tol_s: int, pick: str, name: str
) -> Stage:
    """Future value of ``col`` around each horizon, within ``tol_s`` seconds either side.

    ``last`` takes the latest non-null value of the frame, ``nearest`` the one closest to the horizon
    (the earlier one of two equally close).
    """

    def build(f: Frames) -> dict[str, Column]:
        out = {}
        for h in horizons:
            at = h * HOUR
            if pick == "last":
                out[name.format(col=col, h=h)] = F.last(col, ignorenulls=True).over(
                    f.between(at - tol_s, at + tol_s)
                )
                continue
            seen = F.when(F.col(col).isNotNull(), F.struct(F.col(f.sec).alias("s"), F.col(col).alias("v")))
            lo = F.last(seen, ignorenulls=True).over(f.between(at - tol_s, at))
            hi = F.first(seen, ignorenulls=True).over(f.between(at, at + tol_s))
            goal = F.col(f.sec) + F.lit(at)
            closer_hi = (hi["s"] - goal) < (goal - lo["s"])
            out[name.format(col=col, h=h)] = F.when(lo.isNull() | closer_hi, hi["v"]).otherwise(lo["v"])
        return out

    return build


# --- operators ----------------------------------------------------------------------------------


def lag_features(
    df: DataFrame,
    ts: str,
    lags: Mapping[str, Sequence[int]],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    name: str = "{col}_lag_{n}h",
    **blocks,
) -> DataFrame:
    """Value of each column n rows earlier. Lags count rows, not hours."""
    depth = max(n for ns in lags.values() for n in ns)
    return over_blocks(
        df, ts, [lag_stage(lags, name)], keys, tie, before=depth, uses=list(lags), **blocks
    )


def diff_features(
    df: DataFrame, ts: str, cols: Sequence[str], keys: Sequence[str] = (), tie: Sequence[str] = (), **blocks
) -> DataFrame:
    """First difference and relative change of each column against the previous row."""
    return over_blocks(df, ts, [diff_stage(cols)], keys, tie, before=1, uses=cols, **blocks)


def elapsed_hours(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    out: str = "delta_t_hours",
    **blocks,
) -> DataFrame:
    """Hours since the previous row."""
    return over_blocks(df, ts, [elapsed_stage(out)], keys, tie, before=1, uses=[], **blocks)


def velocity(
    df: DataFrame,
    ts: str,
    cols: Mapping[str, str],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    **blocks,
) -> DataFrame:
    """Change per hour since the previous row."""
    return over_blocks(
        df, ts, [velocity_stage(cols)], keys, tie, before=1, uses=list(cols.values()), **blocks
    )


def acceleration(
    df: DataFrame,
    ts: str,
    cols: Mapping[str, str],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    **blocks,
) -> DataFrame:
    """Velocity and its change per hour; the first two rows of a series have no acceleration."""
    stages = [velocity_stage(cols), acceleration_stage(list(cols))]
    return over_blocks(df, ts, stages, keys, tie, before=2, uses=list(cols.values()), **blocks)


def lead_gap(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    next_ts: str = "next_ts",
    hours: str = "hours_to_next",
    **blocks,
) -> DataFrame:
    """Time of the next row and hours until it."""
    return over_blocks(df, ts, [lead_stage(ts, next_ts, hours)], keys, tie, after=1, uses=[], **blocks)


def drop_after_gap(
    df: DataFrame,
    ts: str,
    max_gap_hours: float,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    **blocks,
) -> DataFrame:
    """Drop each row that comes ``max_gap_hours`` or more after the one before it; the first row stays."""
    timed = elapsed_hours(df, ts, keys, tie, out="_gap", **blocks)
    return timed.where(F.col("_gap").isNull() | (F.col("_gap") < F.lit(float(max_gap_hours)))).drop("_gap")


def horizon_targets(
    df: DataFrame,
    ts: str,
    col: str,
    horizons: Sequence[int] = (2, 4, 6, 8),
    tol_hours: float = 1.5,
    pick: str = "last",
    keys: Sequence[str] = (),
    name: str = "target_{col}_{h}h",
    **blocks,
) -> DataFrame:
    """Future values of ``col`` per horizon; the input has one row per series and second."""
    tol = int(tol_hours * HOUR)
    lo, hi = min(horizons) * HOUR - tol, max(horizons) * HOUR + tol
    return over_blocks(
        df,
        ts,
        [target_stage(col, horizons, tol, pick, name)],
        keys,
        back_s=max(0, -lo),
        fwd_s=max(0, hi),
        unique=True,
        uses=[col],
        **blocks,
    )


def _rolling_unique(
    df: DataFrame, ts: str, rolls: Sequence[Roll], keys: Sequence[str], width_s: int | None
) -> DataFrame:
    return over_blocks(
        df,
        ts,
        [roll_stage(rolls)],
        keys,
        back_s=max(r.back_s for r in rolls),
        fwd_s=max(0, *[r.fwd_s for r in rolls]),
        width_s=width_s,
        unique=True,
        uses=list(dict.fromkeys(r.col for r in rolls)),
    )


def rolling(
    df: DataFrame,
    ts: str,
    rolls: Sequence[Roll],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    unique: bool = False,
    width_s: int | None = None,
) -> DataFrame:
    """Rolling values over time-range frames, both ends included.

    ``unique`` input (one row per series and second, on a coarse grain such as hours) is framed as it is.
    Any other input is first reduced to partial sums per series and second, combined map-side: a range
    frame gives the same answer to all rows of one second, so the answers are joined back. Their cost
    does not depend on the number of rows in a frame (see ``_two_chunks``), and no window group holds
    more rows than a frame has seconds. Frames that look ahead need ``unique`` input.
    """
    cols = list(dict.fromkeys(r.col for r in rolls))
    if unique:
        # NaN counts as missing in the frames and stays in the columns
        shown = {c: f"_rolled_{i}" for i, c in enumerate(cols) if dict(df.dtypes)[c] in ("double", "float")}
        if shown:
            numbers = nan_to_null(df.withColumns({s: F.col(c) for c, s in shown.items()}), list(shown.values()))
            moved = [Roll(r.out, shown.get(r.col, r.col), r.fn, r.back_s, r.fwd_s) for r in rolls]
            return _rolling_unique(numbers, ts, moved, keys, width_s).drop(*shown.values())
        return _rolling_unique(df, ts, rolls, keys, width_s)
    if any(r.fwd_s for r in rolls):
        raise ValueError("frames that look ahead need one row per series and second")

    keys = list(keys)
    timed = df.withColumn(_AT, epoch_s(ts))
    found = nan_to_null(timed, cols)
    parts = []
    for c, fns in _needs(rolls).items():
        x = F.col(c).cast("double")
        parts.append(F.count(c).alias(f"_n_{c}"))
        parts.append(F.coalesce(F.sum(x), F.lit(0.0)).alias(f"_sum_{c}"))
        if "stddev" in fns:
            parts.append(F.coalesce(F.var_pop(x) * F.count(c), F.lit(0.0)).alias(f"_m2_{c}"))
        if "min" in fns:
            parts.append(F.min(c).alias(f"_min_{c}"))
        if "max" in fns:
            parts.append(F.max(c).alias(f"_max_{c}"))
        if "last" in fns:
            pos = F.struct(epoch_us(ts), *[F.col(t) for t in tie])
            parts.append(F.max_by(c, F.when(F.col(c).isNotNull(), pos)).alias(f"_last_{c}"))
    slim = found.where(F.col(ts).isNotNull()).groupBy(*keys, _AT).agg(*parts)
    for back in sorted({r.back_s for r in rolls}):
        slim = _two_chunks(slim, keys, back, [r for r in rolls if r.back_s == back])

    outs = [r.out for r in rolls]
    done = slim.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(_AT).alias("_at"), *outs)
    on = timed[_AT].eqNullSafe(done["_at"])
    for k in keys:
        on = on & timed[k].eqNullSafe(done[f"_k_{k}"])
    return timed.join(done, on, "left").select(*df.columns, *outs)


_AT = "_roll_s"


def _needs(rolls: Sequence[Roll]) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for r in rolls:
        out.setdefault(r.col, set()).add(r.fn)
    return out


def _two_chunks(slim: DataFrame, keys: list[str], back: int, rolls: Sequence[Roll]) -> DataFrame:
    """Rolling values over [t - back, t] for partial sums per second.

    Time is cut into chunks as long as the frame. A frame then consists of the rows of its own chunk up
    to t and the rows of the chunk before from t - back on. Both are running aggregates, forwards and
    backwards, so each row costs the same however many rows its frame holds, and nothing is subtracted.
    The backward aggregates move one frame ahead in time, where the row that needs one finds it as the
    nearest that is not earlier.
    """
    chunk, length = "_chunk", back + 1
    part = [*keys, chunk]
    upto = Window.partitionBy(*part).orderBy(F.col(_AT).asc()).rowsBetween(Window.unboundedPreceding, 0)
    downto = Window.partitionBy(*part).orderBy(F.col(_AT).desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    needs = _needs(rolls)

    cut = slim.withColumn(chunk, F.floor(F.col(_AT) / F.lit(length)))
    for c, fns in needs.items():
        if "stddev" in fns:
            # squares are taken around the mean of the chunk, which keeps them well conditioned
            mean = F.try_divide(F.sum(f"_sum_{c}").over(whole), F.sum(f"_n_{c}").over(whole))
            cut = cut.withColumn(f"_c_{c}", F.coalesce(mean, F.lit(0.0)))

    def running(c: str, fns: set[str], w: WindowSpec) -> Column:
        n, total = F.col(f"_n_{c}"), F.col(f"_sum_{c}")
        fields = [F.sum(n).over(w).alias("n"), F.sum(total).over(w).alias("sum")]
        if "stddev" in fns:
            dev = total - n * F.col(f"_c_{c}")
            sq = F.coalesce(F.try_divide(dev * dev, n), F.lit(0.0)) + F.col(f"_m2_{c}")
            fields += [F.sum(dev).over(w).alias("dev"), F.sum(sq).over(w).alias("sq"), F.col(f"_c_{c}").alias("c")]
        if "min" in fns:
            fields.append(F.min(f"_min_{c}").over(w).alias("min"))
        if "max" in fns:
            fields.append(F.max(f"_max_{c}").over(w).alias("max"))
        if "last" in fns:
            newest = F.last if w is upto else F.first
            fields.append(newest(f"_last_{c}", ignorenulls=True).over(w).alias("last"))
        return F.struct(*fields)

    own = [running(c, fns, upto).alias(f"_own_{c}") for c, fns in needs.items()]
    tail = F.struct(*[running(c, fns, downto).alias(c) for c, fns in needs.items()])
    both = cut.select(*slim.columns, chunk, *own, tail.alias("_tail"))
    rows = both.select(*slim.columns, chunk, *[f"_own_{c}" for c in needs], F.lit(1).alias("_kind"))
    moved = both.select(
        *keys, (F.col(_AT) + back).alias(_AT), (F.col(chunk) + 1).alias(chunk), "_tail", F.lit(0).alias("_kind")
    )
    ahead = (
        Window.partitionBy(*part)
        .orderBy(F.col(_AT).desc(), F.col("_kind").asc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        rows.unionByName(moved, allowMissingColumns=True)
        .withColumn("_before", F.last("_tail", ignorenulls=True).over(ahead))
        .where(F.col("_kind") == 1)
    )
    return found.select(
        *slim.columns, *[_joined(F.col(f"_own_{r.col}"), F.col("_before")[r.col], r.fn).alias(r.out) for r in rolls]
    )


def _joined(own: Column, before: Column, fn: str) -> Column:
    """One rolling value from the aggregates of both chunks."""
    n0, n1 = F.coalesce(before["n"], F.lit(0)), own["n"]
    total = own["sum"] + F.coalesce(before["sum"], F.lit(0.0))
    if fn == "count":
        return n0 + n1
    if fn == "sum":
        return F.when(n0 + n1 > 0, total)
    if fn == "avg":
        return F.try_divide(total, n0 + n1)
    if fn == "min":
        return F.least(own["min"], before["min"])
    if fn == "max":
        return F.greatest(own["max"], before["max"])
    if fn == "last":
        return F.coalesce(own["last"], before["last"])

    def centred(x: Column) -> tuple[Column, Column]:
        mean = F.coalesce(x["c"] + F.try_divide(x["dev"], x["n"]), F.lit(0.0))
        spread = F.coalesce(x["sq"] - F.try_divide(x["dev"] * x["dev"], x["n"]), F.lit(0.0))
        return mean, F.greatest(spread, F.lit(0.0))

    (mean0, m0), (mean1, m1) = centred(before), centred(own)
    gap = mean1 - mean0
    m2 = m0 + m1 + F.coalesce(F.try_divide(gap * gap * n0 * n1, n0 + n1), F.lit(0.0))
    return F.when(n0 + n1 > 1, F.sqrt(F.try_divide(m2, n0 + n1 - 1)))
