"""File and table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """UTF-8 CSV with a header row."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def export_results(df: DataFrame, folder: str, run_id: str, now: datetime) -> str:
    """CSV export under ``results_{run_id}_{yyyymmdd_HHMM}.csv``."""
    return write_csv(df, f"{folder}/results_{run_id}_{now:%Y%m%d_%H%M}.csv")


def read_contract(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ts: str | None = None,
    time_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Parquet under a declared schema; ``time_range`` [from, to) reaches the scan."""
    return _in_range(spark.read.schema(schema).parquet(path), ts, time_range)


def read_table(
    spark: SparkSession,
    path: str,
    ts: str | None = None,
    time_range: tuple[str, str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Parquet with the schema of the files; ``time_range`` [from, to) reaches the scan.

    ``dated`` tells that the table is partitioned by the year, month and day of ``ts`` (``with_date_parts``);
    partitions outside the range are then not read.
    """
    return _in_range(spark.read.parquet(path), ts, time_range, dated)


def _in_range(
    df: DataFrame, ts: str | None, time_range: tuple[str, str] | None, dated: bool = False
) -> DataFrame:
    if ts is None or time_range is None:
        return df
    kind = df.schema[ts].dataType
    lo, hi = (F.lit(t).cast(kind) for t in time_range)
    df = df.where((F.col(ts) >= lo) & (F.col(ts) < hi))
    if dated:
        day = F.make_date("year", "month", "day")
        df = df.where(day.between(*[F.lit(t).cast("timestamp").cast("date") for t in time_range]))
    return df


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
) -> str:
    """Parquet; ``dynamic`` replaces only the partitions present in the frame."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        if not partition_by:
            raise ValueError("dynamic overwrite needs partition columns")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **properties: str) -> None:
    """Replace a database table. The driver jar of the database must be on the class path."""
    df.write.mode(mode).jdbc(url, table, properties=properties)


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """year, month and day of the event time; rows without a readable time get the current date."""
    at = F.coalesce(F.col(ts).try_cast("timestamp"), F.current_timestamp())
    return df.select(
        "*", F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day")
    )
