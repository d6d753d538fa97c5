"""Ordered windows over series of any length, without one task per series.

A window partitioned by series alone puts a whole series, or the one hot series that holds a third
of the table, into a single task. Here every series is cut into blocks of time, and the window is
partitioned by (series, block). What a frame needs from outside its block is added as extra rows
before the shuffle and filtered out afterwards:

* *halo rows* for RANGE frames: each row is also sent to the blocks whose frames can reach it;
* *carried rows* for ROW frames: the last ``before`` rows ahead of a block and the first ``after``
  rows behind it, however far away they lie in time.

Rows stay in their blocks otherwise, so the table is shuffled once. The carried rows come from at
most ``before + after`` rows per block. Blocks with too many rows are cut into parts, and parts into parts; rows
are carried between the parts of one block at a time, so the only per-series step works on the widest blocks,
whose number is set by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_s, epoch_us
from ..sources.staging import staged

HOUR = 3600
DAY = 24 * HOUR
MICROS = 1_000_000
WIDE = 365 * DAY  # block width where hot blocks are cut anyway: short series then need no extra rows

_BLK, _CORE, _S, _US, _LEVELS = "_block", "_core", "_sec", "_micros", "_levels"
_FAN = 64
_SENT_WHOLE = 100_000
_UNTIMED = 1 << 20


@dataclass(frozen=True)
class Frames:
    """Window specs handed to feature builders; the event time in seconds is the column ``sec``."""

    part: tuple[str, ...]
    order: tuple[Column, ...]
    sec: str = _S

    @property
    def rows(self) -> WindowSpec:
        return Window.partitionBy(*self.part).orderBy(*self.order)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.part)

    def between(self, lo_s: int, hi_s: int) -> WindowSpec:
        """Rows whose time lies in [t + lo_s, t + hi_s], both ends included."""
        return Window.partitionBy(*self.part).orderBy(self.sec).rangeBetween(lo_s, hi_s)


Stage = Callable[[Frames], dict[str, Column]]


def block_start(us: Column, width_us: Column | int) -> Column:
    """Start, in microseconds, of the block that holds ``us``."""
    width = width_us if isinstance(width_us, Column) else F.lit(width_us)
    return us - F.pmod(us, width)


@dataclass(frozen=True)
class HotBlocks:
    """Blocks above the row limit, level by level: those of the widest blocks, then of their parts, and so on,
    with the width of the parts in microseconds, and the single microseconds that are above it on their own,
    with their row counts. All of them are stored tables with at most rows / max_rows rows a level."""

    levels: tuple[tuple[DataFrame, int], ...]
    tied: DataFrame | None


def hot_blocks(
    df: DataFrame, us: Column, keys: Sequence[str], width_us: int, max_rows: int
) -> HotBlocks | None:
    """Find the blocks that hold more than ``max_rows`` rows and cut them into ``_FAN`` parts, again and again,
    until each part fits or is one microsecond wide.

    Rows are only counted, and counts are combined map-side, so a hot block costs nothing extra here. A part is
    cut no further than it must be, so evenly filled parts keep at least max_rows / _FAN rows.
    """
    frame = df.select(*keys, us.alias(_US)).withColumn("_b", block_start(F.col(_US), width_us))
    levels: list[tuple[DataFrame, int]] = []
    width = width_us
    while True:
        counts = frame.groupBy(*keys, "_b").count().where(F.col("count") > max_rows)
        if counts.isEmpty():
            return HotBlocks(tuple(levels), None) if levels else None
        hot = staged(counts.select(*keys, "_b", F.col("count").alias("_rows")))
        if width == 1:
            return HotBlocks(tuple(levels), hot)
        width = -(-width // _FAN)
        levels.append((hot.drop("_rows"), width))
        inside = left_lookup(frame, levels[-1][0].withColumn("_hot", F.lit(True)), keys, "_b", "_b0", "_b").where("_hot")
        frame = inside.select(*keys, _US, _part(F.col(_US), F.col("_b"), width).alias("_b"))


def _part(us: Column, start: Column, width: int) -> Column:
    """Start of the part that holds ``us``; parts begin at the start of their block."""
    return us - F.pmod(us - start, F.lit(width))


def assign_blocks(
    df: DataFrame,
    us: Column,
    keys: Sequence[str],
    width_s: int,
    max_rows: int | None,
) -> tuple[DataFrame, HotBlocks | None]:
    """Add the block column; blocks above ``max_rows`` are cut into narrower ones.

    A row of a cut block also has the starts of the blocks around its own, widest first, in ``_levels``; where
    a block is not cut as far as others its own start is repeated.
    """
    width_us = width_s * MICROS
    plain = df.withColumn(_US, us).withColumn(_BLK, block_start(F.col(_US), width_us))
    hot = None if max_rows is None else hot_blocks(df, us, keys, width_us, max_rows)
    if hot is None:
        return plain, None
    out = plain.withColumn(_LEVELS, F.array(_BLK)).withColumn("_cut", F.lit(True))
    for nodes, width in hot.levels:
        out = left_lookup(out, nodes.withColumn("_hot", F.lit(True)), keys, _BLK, "_b0", "_b")
        cut = F.col("_cut") & F.coalesce("_hot", F.lit(False))
        block = F.when(cut, _part(F.col(_US), F.col(_BLK), width)).otherwise(F.col(_BLK))
        out = out.select(
            *df.columns, _US, block.alias(_BLK), F.concat(_LEVELS, F.array(block)).alias(_LEVELS), cut.alias("_cut")
        )
    return out.drop("_cut"), hot


def left_lookup(
    df: DataFrame, small: DataFrame, keys: Sequence[str], col: str, small_col: str, named: str | None = None
) -> DataFrame:
    """Left join with a stored table of hot blocks, null-safe on the keys. It is sent whole while it is small;
    Spark shuffles both sides beyond that. ``named`` is the column's name in ``small``."""
    right = small.withColumnsRenamed({k: f"_k_{k}" for k in keys} | ({named: small_col} if named else {}))
    on = df[col].eqNullSafe(right[small_col])
    for k in keys:
        on = on & df[k].eqNullSafe(right[f"_k_{k}"])
    right = F.broadcast(right) if small.count() <= _SENT_WHOLE else right
    return df.join(right, on, "left").drop(*[f"_k_{k}" for k in keys], *([small_col] if named else []))


def _carried(
    blocked: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    forward: bool,
    levels: int,
) -> DataFrame:
    """Up to ``n`` rows nearest to each block from outside it, tagged with the block that needs them.

    ``forward`` sends rows to later blocks (for look-back frames), otherwise to earlier ones. The row
    limit per block is applied before the shuffle as well as after it.

    Where blocks are cut, rows go up and down the levels of the cut: the last ``n`` rows of the parts of a block
    give those of the block; a block passes what it was sent on to its first parts, and each part sends its rows
    to the parts behind it. No window holds more than the rows of ``_FAN`` parts, except over the widest blocks
    of a series, whose number is set by the calendar.
    """
    ahead = [c.asc() for c in order] if forward else [c.desc() for c in order]
    behind = [c.desc() for c in order] if forward else [c.asc() for c in order]

    def last(frame: DataFrame, part: Column | str) -> DataFrame:
        nearest = Window.partitionBy(*keys, part).orderBy(*behind)
        return frame.withColumn("_rn", F.row_number().over(nearest)).where(F.col("_rn") <= n).drop("_rn")

    def sent(frame: DataFrame, around: list[Column | str]) -> DataFrame:
        """Rows of ``frame``, once for each ``_node`` among the next n rows that is not their own."""
        beyond = Window.partitionBy(*keys, *around).orderBy(*ahead).rowsBetween(1, n)
        return (
            frame.withColumn("_next", F.collect_list("_node").over(beyond))
            .withColumn("_to", F.explode(F.array_distinct("_next")))
            .where(~F.col("_to").eqNullSafe(F.col("_node")))
            .drop("_next", "_node")
        )

    edge = last(blocked, _BLK)
    if not levels:
        return sent(edge.withColumn("_node", F.col(_BLK)), [])
    edges = [staged(edge)]
    for level in reversed(range(levels)):
        edges.insert(0, last(edges[0].withColumn("_at", F.get(_LEVELS, F.lit(level))), "_at").drop("_at"))
    down = sent(edges[0].withColumn("_node", F.get(_LEVELS, F.lit(0))), [])
    for level in range(1, levels + 1):
        own = edges[level].select(
            "*", F.get(_LEVELS, F.lit(level - 1)).alias("_around"), F.get(_LEVELS, F.lit(level)).alias("_node")
        )
        above = down.withColumnRenamed("_to", "_around").withColumn("_node", F.lit(None).cast("long"))
        down = sent(own.unionByName(above), ["_around"]).drop("_around")
    return down


def over_blocks(
    df: DataFrame,
    ts: str,
    stages: Sequence[Stage],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    back_s: int = 0,
    fwd_s: int = 0,
    width_s: int | None = None,
    max_rows: int | None = 4_000_000,
    unique: bool = False,
    uses: Sequence[str] | None = None,
) -> DataFrame:
    """Add windowed columns to every row, with windows cut into (series, block).

    ``stages`` are applied one after the other, each to the columns of the ones before it.
    ``before``/``after`` say how many rows, ``back_s``/``fwd_s`` how many seconds, the frames reach
    beyond a row. ``unique`` promises one row per series and second: it bounds a block by its width
    and is required for time frames (``rolling`` reduces other input to that form). Without it, blocks
    above ``max_rows`` rows are cut; rows of one series and microsecond stay together. ``uses`` names
    the columns the stages read, so that extra rows carry no others. Rows without a time stay, and all new
    columns are NULL there; they are spread by hash.
    """
    if (back_s or fwd_s) and not unique:
        raise ValueError("time frames need one row per series and second")
    keys = list(keys)
    ranged = bool(back_s or fwd_s)
    width = width_s or (max(4 * (back_s + fwd_s), 30 * DAY) if unique else WIDE)
    blocked, hot = assign_blocks(df, epoch_us(ts), keys, width, None if unique else max_rows)
    levels = len(hot.levels) if hot else 0
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    untimed = F.pmod(F.xxhash64(*hashable), F.lit(_UNTIMED)) - _UNTIMED - (1 << 62)  # before all times
    blocked = blocked.withColumn(_S, epoch_s(ts)).withColumn(_BLK, F.coalesce(_BLK, untimed))
    order = [F.col(_S)] if unique else [F.col(_US), *[F.col(t) for t in tie]]

    keep = None if uses is None else {*uses, *keys, *tie, ts, _S, _US, _BLK, _LEVELS}

    def thin(frame: DataFrame) -> DataFrame:
        if keep is None:
            return frame
        types = {f.name: f.dataType for f in df.schema.fields}
        return frame.select(
            *[
                F.col(c) if c in keep or c not in types else F.lit(None).cast(types[c]).alias(c)
                for c in frame.columns
            ]
        )

    parts = []
    if ranged:
        w_us = width * MICROS
        first = block_start(F.col(_US) - F.lit(fwd_s * MICROS), w_us)
        last = block_start(F.col(_US) + F.lit(back_s * MICROS), w_us)
        reached = F.when(F.col(_US).isNull(), F.array(_BLK)).otherwise(F.sequence(first, last, F.lit(w_us)))
        halo = blocked.withColumn("_to", F.explode(reached))
        parts.append(
            halo.withColumn(_CORE, F.col("_to") == F.col(_BLK)).drop(_BLK).withColumnRenamed("_to", _BLK)
        )
    else:
        parts.append(blocked.withColumn(_CORE, F.lit(True)))
    for n, forward in ((before, True), (after, False)):
        if not n:
            continue
        extra = _carried(thin(blocked).where(F.col(_US).isNotNull()), keys, order, n, forward, levels)
        if ranged:
            lo = F.col("_to") - F.lit(back_s * MICROS)
            hi = F.col("_to") + F.lit((width + fwd_s) * MICROS)
            extra = extra.where((F.col(_US) < lo) if forward else (F.col(_US) >= hi))
        parts.append(
            extra.withColumn(_CORE, F.lit(False)).drop(_BLK).withColumnRenamed("_to", _BLK)
        )
    frame = parts[0]
    for p in parts[1:]:
        frame = frame.unionByName(p)

    frames = Frames(part=(*keys, _BLK), order=tuple(order))
    for stage in stages:
        new = {name: F.when(F.col(_US).isNotNull(), e) for name, e in stage(frames).items()}
        frame = frame.select(
            *[c for c in frame.columns if c not in new], *[e.alias(n) for n, e in new.items()]
        )
    return frame.where(_CORE).drop(_BLK, _CORE, _S, _US, _LEVELS)
