"""Declarative description of a plant: contract, rules and features. The operators know no column names;
everything specific to one process lives in a spec such as ``furnace.py``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column

from ..operators.windows import Roll
from ..sources.contract import Contract


@dataclass(frozen=True)
class FeatureSpec:
    """Feature columns of one series table, by kind."""

    row_features: Callable[[], dict[str, Column]]  # from the row alone
    lags: Mapping[str, Sequence[int]]
    rolls: Sequence[Roll]
    diffs: Sequence[str]
    velocities: Mapping[str, str]
    accelerations: Sequence[str]
    target: str
    horizons: Sequence[int] = (2, 4, 6, 8)
    tolerance_hours: float = 1.5
    pick: str = "last"
    max_gap_hours: float = 6.0
    essential: Sequence[str] = ()
    pi: float | None = None
    next_time: str = "next_si_dt"
    next_hours: str = "hours_to_next_cast"
    elapsed: str = "delta_t_hours"
    order: Sequence[str] = field(default_factory=tuple)  # output order; anything else follows


@dataclass(frozen=True)
class CleaningStep:
    """Rules and quantile trimming of one column group.

    ``bounds_after_rules`` takes the quantiles from the rows that pass this group's own rules, otherwise
    from the rows that reached the step.
    """

    name: str
    rules: Sequence[str]
    trim: Sequence[str] = ()
    lo: float = 0.01
    hi: float = 0.99
    bounds_after_rules: bool = False


@dataclass(frozen=True)
class PlantSpec:
    contract: Contract
    validity: Sequence[str]
    trusted: str
    features: FeatureSpec
    cleaning: Sequence[CleaningStep]
