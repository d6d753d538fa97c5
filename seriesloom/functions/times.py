"""Time expressions. Every one accepts TIMESTAMP and TIMESTAMP_NTZ; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_us(ts) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def epoch_s(ts) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def hours_between(start, end) -> Column:
    """Hours from ``start`` to ``end`` at whole-second resolution."""
    return (epoch_s(end) - epoch_s(start)) / F.lit(3600.0)


def minutes_between(start, end) -> Column:
    """Minutes from ``start`` to ``end``, fractions kept."""
    return (epoch_us(end) - epoch_us(start)) / F.lit(60e6)


def trunc(ts, grain: str) -> Column:
    """Start of the ``grain`` (hour, day, ...) that holds ``ts``, without a zone."""
    return F.date_trunc(grain, _c(ts)).cast("timestamp_ntz")


def parse_ts(text) -> Column:
    """Lenient string to timestamp: anything unreadable becomes NULL."""
    return F.try_to_timestamp(_c(text)).cast("timestamp_ntz")


def time_parts(ts) -> dict[str, Column]:
    """hour, day_of_week (1 = Sunday), day_of_month and month."""
    t = _c(ts)
    return {
        "hour": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "day_of_month": F.dayofmonth(t),
        "month": F.month(t),
    }


def cyclic(x, period: float, pi: float | None = None) -> tuple[Column, Column]:
    """(sin, cos) of ``x`` on a circle of length ``period``."""
    angle = F.lit(2.0) * (F.pi() if pi is None else F.lit(pi)) * _c(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
