"""Silver layer: flagged, imputed, deduplicated, hourly sensors joined with the latest target per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null, parse_ts, trunc
from ..operators.dedup import first_per
from ..operators.quality import flag_invalid, impute, pool_means
from ..operators.resample import resample
from .spec import PlantSpec


def build_silver(
    sensors: DataFrame,
    targets: DataFrame,
    spec: PlantSpec,
    keys: Sequence[str] = (),
    drop_outliers: bool = False,
) -> DataFrame:
    """One complete row per series and hour that has both sensor readings and a target.

    Flagged readings are imputed but kept unless ``drop_outliers``. Of several readings at one time the
    one with the greatest tag counts; of several targets in one hour the latest.
    """
    c, keys = spec.contract, list(keys)
    cols, at = c.sensors, c.refined_time

    # Repair follows the shuffle of the dedup: it touches only the readings that are kept, and neither
    # side of the shuffle grows a generated method beyond what the JVM compiles.
    flagged = flag_invalid(sensors, spec.validity)
    pool = pool_means(flagged, spec.trusted, cols).first().asDict()
    timed = flagged.withColumn(at, parse_ts(c.time))  # the join drops readings without a time
    order = [F.col(x).desc_nulls_last() for x in (c.tag, *cols)]
    if drop_outliers:
        # valid readings first, so that the filter may follow the choice of one reading per time
        order = [F.col("is_outlier").asc(), *order]
    readings = first_per(timed.select(*keys, at, c.tag, *cols, "is_outlier"), [*keys, at], order)
    if drop_outliers:
        readings = readings.where(F.col("is_outlier") == 0)
    readings = impute(readings, cols, "is_outlier", pool)
    hourly = resample(readings, at, "hour", dict.fromkeys(cols, "avg"), keys, without_nan=True)  # impute left none

    (target,) = c.target
    labelled = (
        nan_to_null(targets)
        .withColumn("_t", parse_ts(c.time))
        .where(F.col("_t").isNotNull())
        .select(*keys, trunc("_t", "hour").alias(at), "_t", target)
    )
    latest = first_per(
        labelled, [*keys, at], [F.col("_t").desc(), F.col(target).desc_nulls_last()]
    ).drop("_t")
    return (
        hourly.join(latest, [*keys, at], "inner")
        .select(*keys, at, target, *cols)
        .na.drop(subset=[at, target, *cols])
    )
