"""As-of join: each left row gets the right row that was in effect at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_us, minutes_between
from .blocks import MICROS, WIDE, assign_blocks, left_lookup

_SIDE, _R, _L, _T, _BLK, _US, _COPIES = "_side", "_right", "_left", "_tie", "_block", "_micros", "_copies"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    lt: str,
    rt: str,
    keys: Sequence[str] = (),
    direction: str = "backward",
    tolerance_s: float | None = None,
    tie: Sequence[str] = (),
    width_s: int = WIDE,
    max_rows: int | None = 4_000_000,
) -> DataFrame:
    """Join every left row with the nearest right row at or before it (``backward``), at or after it
    (``forward``) or on either side (``nearest``; backward wins when equally close).

    Unmatched left rows are kept with NULLs. Right columns that share a name with a left column must be
    renamed first, the keys excepted. Among right rows of one time, ``tie`` picks: the greatest for
    backward, the smallest for forward. A match further away than ``tolerance_s`` is discarded.

    Both sides are cut into (series, block of time) and shuffled together once. The right row in effect
    at the start of a block comes from a table with one row per series and block, reduced map-side, so
    neither a long nor a hot series ends up in one task. Blocks above ``max_rows`` are cut further; if a
    single time is above it, its left rows are spread by hash and exact copies are counted first.
    """
    keys = list(keys)
    values = [c for c in right.columns if c not in keys]
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    packed_left = F.struct(*[F.col(c) for c in left.columns])
    base = left.select(*keys, F.col(lt).alias("_t"), packed_left.alias(_L))
    picked = F.struct(*[F.col(c) for c in values])
    facts = right.where(F.col(rt).isNotNull()).select(
        *keys, F.col(rt).alias("_t"), picked.alias(_R), F.struct(epoch_us(rt), *[F.col(t) for t in tie]).alias(_T)
    )

    def matched(sign: int, out: str) -> DataFrame:
        return _match(base, facts, keys, sign, out, width_s, max_rows)

    if direction == "backward":
        found = matched(1, "_m")
    elif direction == "forward":
        found = matched(-1, "_m")
    elif direction == "nearest":
        both = _match(matched(1, "_b").select(*keys, "_t", _L, "_b"), facts, keys, -1, "_f", width_s, max_rows)
        to_b, to_f = epoch_us("_t") - epoch_us(F.col("_b")[rt]), epoch_us(F.col("_f")[rt]) - epoch_us("_t")
        found = both.withColumn(
            "_m", F.when(F.col("_b").isNull() | (to_f < to_b), F.col("_f")).otherwise(F.col("_b"))
        )
    else:
        raise ValueError(f"direction {direction!r}")

    m = F.col("_m")
    if tolerance_s is not None:
        away = F.abs(epoch_us("_t") - epoch_us(m[rt]))
        m = F.when(away <= F.lit(int(tolerance_s * MICROS)), m)
    return found.select(
        *[F.col(_L)[c].alias(c) for c in left.columns], *[m[c].alias(c) for c in values]
    )


def _match(
    base: DataFrame,
    facts: DataFrame,
    keys: list[str],
    sign: int,
    out: str,
    width_s: int,
    max_rows: int | None,
) -> DataFrame:
    """Last right row at or before each left row along ``sign`` * time."""
    extra = [c for c in base.columns if c not in (*keys, "_t", _L)]

    def stacked(left: DataFrame) -> DataFrame:
        rows = left.select(*keys, "_t", F.lit(1).alias(_SIDE), _L, *extra, *([_COPIES] if _COPIES in left.columns else []))
        return rows.unionByName(facts.select(*keys, "_t", F.lit(0).alias(_SIDE), _R, _T), allowMissingColumns=True)

    both, hot = assign_blocks(stacked(base), F.lit(sign) * epoch_us("_t"), keys, width_s, max_rows)
    tied, copied = None, hot is not None and hot.tied is not None
    if copied:
        # Copies of a row have the same match: they are counted before the shuffle and repeated after it.
        counted = base.groupBy(*keys, "_t", _L, *extra).agg(F.count(F.lit(1)).alias(_COPIES))
        both, hot = assign_blocks(stacked(counted), F.lit(sign) * epoch_us("_t"), keys, width_s, max_rows)
        tied = None if hot is None else hot.tied
    if tied is not None:
        salts = F.ceil(F.col("_rows") / max_rows).cast("int")
        marks = tied.select(*keys, "_b", F.lit(True).alias("_is_tied"), salts.alias("_salts"))
        both = left_lookup(both, marks, keys, _BLK, "_b", "_b")
        # All rows of such a block share one time, so its left rows need no order and may be spread.
        spread = F.col("_is_tied") & (F.col(_SIDE) == 1)
        salt = F.when(spread, F.pmod(F.xxhash64(_L), F.col("_salts"))).otherwise(0)
        both = both.withColumn("_salt", salt.cast("int"))
        part = [*keys, _BLK, "_salt"]
    else:
        part = [*keys, _BLK]

    # the tie-break ascends for backward and descends for forward, so that the last row wins
    newest = F.max_by if sign > 0 else F.min_by
    per_block = both.groupBy(*keys, _BLK).agg(
        newest(_R, F.when(F.col(_SIDE) == 0, F.col(_T))).alias("_here"),
        F.max(_SIDE).alias("_any_left"),
        *([F.max("_is_tied").alias("_is_tied"), F.max("_salts").alias("_salts")] if tied is not None else []),
    )
    if tied is not None:  # the row in effect at such a time is known already
        both = both.where(F.col("_is_tied").isNull() | (F.col(_SIDE) == 1))
    opening = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.withColumn(_R, F.last("_here", ignorenulls=True).over(opening))
    if tied is not None:
        carried = carried.withColumn(
            _R, F.when(F.col("_is_tied"), F.coalesce("_here", _R)).otherwise(F.col(_R))
        ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))))
    carried = carried.where((F.col("_any_left") == 1) & F.col(_R).isNotNull()).select(
        *part, F.lit(-1).alias(_SIDE), _R
    )
    w = (
        Window.partitionBy(*part)
        .orderBy(
            (F.col(_SIDE) >= 0).asc(),
            F.col(_US).asc(),
            F.col(_SIDE).asc(),
            F.col(_T).asc() if sign > 0 else F.col(_T).desc(),
        )
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = (
        both.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.last(_R, ignorenulls=True).over(w))
        .where(F.col(_SIDE) == 1)
    )
    if copied:
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(_COPIES))))
    return found.select(*keys, "_t", _L, *extra, out)


def asof_drift(df: DataFrame, lt: str, rt: str, out: str = "drift_min") -> DataFrame:
    """Minutes between a left row and the right row it was matched with."""
    return df.withColumn(out, minutes_between(rt, lt))
