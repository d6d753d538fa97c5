"""Written intermediate tables whose shuffle files go as soon as the table is there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage_folder, staged

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``staged``, with the shuffle files of the write dropped at its end: nothing reads them again."""
    with _without_shuffle_files(df.sparkSession):
        return staged(df)


def stored_by(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """``stored``, and dealt by hash of a column into buckets without a shuffle: a join or a grouping by that
    column moves only its other side. The files are those of a table that the catalog need not keep."""
    spark, name = df.sparkSession, f"stage_{uuid.uuid4().hex}"
    writer = df.write.option("path", f"{stage_folder(spark)}/{name}").option("compression", "zstd")
    with _without_shuffle_files(spark):
        writer.bucketBy(buckets, column).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")  # of the catalog's entry: the files lie outside the catalog's folder
    return table


def sent_whole(df: DataFrame, most: int = 200_000) -> DataFrame:
    """The stored frame marked for broadcast if it has at most ``most`` rows; otherwise Spark shuffles both
    sides. Rows are expected to be a few numbers wide."""
    return F.broadcast(df) if df.count() <= most else df
